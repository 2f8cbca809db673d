from datetime import date

from riskbook.sources.calendar import biweekly, daily, days, month_ends, weekly


def test_month_ends_start_before_the_first_month_and_know_the_month_before():
    periods = month_ends(date(2016, 2, 1), date(2016, 4, 1))
    assert days(periods) == [date(2016, 1, 31), date(2016, 2, 29), date(2016, 3, 31)]
    assert [p.before for p in periods] == [date(2015, 12, 31), date(2016, 1, 31), date(2016, 2, 29)]


def test_month_ends_leave_out_a_month_not_yet_begun():
    assert days(month_ends(date(2016, 2, 1), date(2016, 2, 29))) == [date(2016, 1, 31)]


def test_weeks_and_fortnights():
    weeks = weekly(date(2017, 5, 4), date(2017, 5, 20))
    assert days(weeks) == [date(2017, 5, 4), date(2017, 5, 11), date(2017, 5, 18)]
    assert weeks[0].before == date(2017, 4, 27)
    assert days(biweekly(date(2017, 5, 4), date(2017, 5, 31))) == [date(2017, 5, 4), date(2017, 5, 18)]
    assert weekly(date(2017, 5, 4), date(2017, 5, 1)) == []


def test_day_report_is_for_yesterday():
    (period,) = daily(date(2017, 3, 1))
    assert (period.day, period.before) == (date(2017, 2, 28), date(2017, 2, 27))
