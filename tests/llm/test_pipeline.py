import zlib

import numpy as np
import pytest
from test_jaccard import brute

import corpus_pipeline
from riskbook.llm import decontaminate, mixing
from riskbook.llm.queries import word_tokenizer
from riskbook.llm.storage import store


@pytest.fixture(scope="module")
def stages(spark, data):
    out = {"documents": spark.read.parquet(f"{data}/documents.parquet")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = store(stage(spark, docs, data), name)
    return out


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "source_mix", "tokens"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes, name


def test_one_of_each_class_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["language"].collect()]
    assert {r["doc_id"] for r in stages["near_duplicates"].collect()} == {c for _, c, _ in brute(rows)}


def test_leaks_go_and_clean_documents_stay(spark, data, stages):
    before = stages["near_duplicates"]
    leaked = {r["doc_id"] for r in decontaminate.leaks(before, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    assert leaked and {r["doc_id"] for r in stages["decontamination"].collect()} == {r["doc_id"] for r in before.collect()} - leaked


def test_mix_meets_its_targets(stages):
    plan = mixing.taken(mixing.takes(stages["decontamination"])).collect()
    words = sum(len((r["text"] or "").split()) for r in stages["source_mix"].collect())
    assert words == sum(r["taken"] for r in plan)


def test_tokens_are_those_of_the_tokenizer(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = []
    for r in stages["source_mix"].collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    rows = sorted(stages["tokens"].collect(), key=lambda r: r["start"])
    assert sorted(want) == sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


def test_odd_documents_and_none(spark, data, stages):
    schema = stages["documents"].schema
    odd = [(None, "The and of in to that is.", None, None, None), (1, None, "en", "s", None), (1, "", "en", "s", 0), (2, "123", None, "s", 3)]
    odd += [(3, "the and of to in is that it was for " * 3000, "en", "s", 1)] * 2
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS key", "2 AS words", "3 AS score")
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, data), name)
            assert name == "tokens" or len(docs.columns) == 8
        # the small source is taken three times, the other one in part
        assert docs.count() == (4 if rows else 0)


def test_operators_share_nothing_with_the_library():
    import ast
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for path in [*(root / "riskbook").rglob("*.py"), *(root / "workload").rglob("*.py")]:
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            named = [a.name for a in node.names] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
            named.append((getattr(node, "module", None) or "") if isinstance(node, ast.ImportFrom) else "")
            assert not any("llm" in name.split(".") for name in named), path
