"""Personal data: regular expressions propose spans, checksums confirm them, context words move the score.

For each kind the text is cut at the pattern's matches (leftmost, not overlapping); the pieces' lengths
give the matches' places in code points.  A validator keeps or drops a match (parts of an address,
Luhn sum of a card, mod-97 of an account number, digits of a phone number); a span's score is its kind's
own plus `LIFT` if one of the kind's words stands within `AROUND` characters.  The base kinds (email,
ip, card, phone) stay whatever their score; the added ones (iban, ssn, local_phone) need `least`.

DataFrame functions only.  Patterns are written so that a failing match is not tried again from the
middle of the same run of characters, which keeps very long texts linear.

Defined cases: a null or empty text has no span; repeated rows give equal results; null identifiers
are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AROUND = 40
LIFT = 0.4


@dataclass(frozen=True)
class Kind:
    """`needs` is a string without which no match is possible; `valid` is SQL over value, digits, ahead, behind."""

    name: str
    pattern: str
    score: float
    words: str
    valid: str = "true"
    needs: str = ""
    base: bool = True


DIGITS = "regexp_replace(value, '[^0-9]', '')"
LUHN = (
    f"aggregate(transform(split(reverse({DIGITS}), ''), (c, i) -> int(c) * (1 + i % 2) - if(i % 2 = 1 and int(c) > 4, 9, 0)), "
    "0, (a, x) -> a + x) % 10 = 0"
)
#: The account number with its first four characters last, letters as 10 to 35, modulo 97.
MOD_97 = (
    "aggregate(split(concat(substring(value, 5), substring(value, 1, 4)), ''), 0, "
    "(a, c) -> if(c >= 'A', (a * 100 + ascii(c) - 55) % 97, (a * 10 + int(c)) % 97)) = 1"
)
APART = r"not (ahead rlike '[0-9A-Za-z+-]$') and not (behind rlike '^[0-9A-Za-z-]')"

KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        "mail|contact|write|reply",
        needs="@",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.6,
        "ip|address|host|server",
        r"value rlike '^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\\.|$)){4}$'",
        needs=".",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.8, "card|credit|visa|pay", f"length({DIGITS}) between 14 and 19 and {LUHN}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|call|tel|mobile|fax", f"length({DIGITS}) between 10 and 15", needs="+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", 0.8, "iban|account|bank", MOD_97, base=False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, "ssn|social security", APART, needs="-", base=False),
    Kind("local_phone", r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}", 0.3, "phone|call|tel|mobile|fax", APART, base=False),
)
BASE = tuple(k.name for k in KINDS if k.base)
SPAN = "array<struct<start:int,kind_order:int,kind:string,end:int,value:string,score:double>>"


def _spans(kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind, from its matches (column m<order>) and the gaps around them (g<order>).

    Context reaches to the next match of the kind at most, so that all of it is read once.
    """
    matches, gaps = f"__m{order}", f"__g{order}"
    placed = (
        f"aggregate(transform({matches}, (m, i) -> named_struct('gap', length({gaps}[i]), 'size', length(m), 'value', m, "
        f"'ahead', right({gaps}[i], {AROUND}), 'behind', left({gaps}[i + 1], {AROUND}))), "
        "named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int,value:string,ahead:string,behind:string>>)), "
        "(a, x) -> named_struct('at', a.at + x.gap + x.size, 'spans', array_append(a.spans, named_struct('start', a.at + x.gap, "
        "'end', a.at + x.gap + x.size, 'value', x.value, 'ahead', x.ahead, 'behind', x.behind))), a -> a.spans)"
    )
    valid = kind.valid.replace("value", "m.value").replace("ahead", "m.ahead").replace("behind", "m.behind")
    near = f"lower(concat(m.ahead, ' ', m.behind)) rlike '{kind.words}'"
    spans = (
        f"transform(filter({placed}, m -> {valid}), m -> named_struct('start', m.start, 'kind_order', {order}, 'kind', '{kind.name}', "
        f"'end', m.end, 'value', m.value, 'score', round({kind.score} + if({near}, {LIFT}, 0.0), 1)))"
    )
    return F.expr(f"if(size({matches}) > 0, cast({spans} as {SPAN}), cast(array() as {SPAN}))")


def find(docs: DataFrame, least: float = 0.6, text: str = "text", out: str = "spans") -> DataFrame:
    """`docs` with an array of spans (start, kind_order, kind, end, value, score) in order of start and kind."""
    columns = [c for c in docs.columns if c != out]
    rows = docs.withColumn("__body", F.coalesce(text, F.lit("")))
    none = F.array().cast("array<string>")
    for i, kind in enumerate(KINDS):
        every = F.regexp_extract_all("__body", F.lit(kind.pattern), F.lit(0))
        rows = rows.withColumn(f"__m{i}", F.when(F.col("__body").contains(kind.needs), every).otherwise(none))
        gaps = F.when(F.size(f"__m{i}") > 0, F.split("__body", kind.pattern, -1)).otherwise(none)
        rows = rows.withColumn(f"__g{i}", gaps)
    rows = rows.select(*columns, *(_spans(k, i).alias(f"__s{i}") for i, k in enumerate(KINDS)))
    kept = [F.col(f"__s{i}") if k.base else F.filter(f"__s{i}", lambda s: s["score"] >= least) for i, k in enumerate(KINDS)]
    return rows.select(*columns, F.array_sort(F.concat(*kept)).alias(out))


def masked(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """`docs` with every span of the text replaced by its kind in angle brackets.

    Of overlapping spans the one that begins first stands for all.
    """
    columns = docs.columns
    rows = find(docs, least, out="__spans")
    pieces = F.expr(
        "aggregate(__spans, named_struct('at', 0, 'text', ''), (a, s) -> if(s.start < a.at, named_struct('at', greatest(a.at, s.end), "
        "'text', a.text), named_struct('at', s.end, 'text', concat(a.text, substring(text, a.at + 1, s.start - a.at), '<', s.kind, '>'))))"
    )
    whole = F.expr("concat(__p.text, substring(text, __p.at + 1))")
    rows = rows.withColumn("__p", pieces).withColumn("text", F.when(F.size("__spans") > 0, whole).otherwise(F.col("text")))
    return rows.select(*columns)


def digests(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, all spans and their scores as strings."""
    rows = find(docs.select("doc_id", "text"), least)

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.expr(f"bigint(size(filter(spans, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in BASE]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 1)), ",").alias("scores"),
    )
