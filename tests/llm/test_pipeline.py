"""The pipeline: each stage against a plain version on its own input."""

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from sparkfolio.llm import byte_bpe, pii
from sparkfolio.llm.spark_env import stored
from tests.conftest import SF_SMALL
from tests.llm.test_texts import counts, groups, shingles


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_SMALL), "test"))
    raw, ruled, single, clean, mixed, ids = [{r.doc_id: r for r in d.collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert ruled and not any(counts(r.text)[-1] for r in ruled.values()) and set(ruled) < set(raw)
    order = sorted(ruled)
    group = groups([shingles(ruled[i].text) for i in order])
    assert set(single) == {order[g] for g in group}
    assert {i: r.text for i, r in clean.items()} == {i: pii.redact_text(r.text) for i, r in single.items()}
    assert set(mixed) <= set(clean) and all(r.n_chars == len(r.text) for r in mixed.values())
    plain = tiktoken.Encoding("p", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert {i: list(r.ids) for i, r in ids.items()} == {i: plain.encode_ordinary(r.text) for i, r in mixed.items()}
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id: list(r.ids) for r in out.collect()} == {i: list(r.ids) for i, r in ids.items()}


def test_stages_on_odd_rows(spark):
    """Null, empty, very long and repeated texts, rows without id, extra columns of odd names, and an empty table."""
    prose = "it was the best of times and it was the worst of times for all of us in the city by the sea "
    long = " ".join(f"the word{i} of page{i}" for i in range(20000))
    texts = [(1, None, "a"), (2, "", "a"), (3, "one", None), (4, prose * 1 + "mail a.b@example.com now", "b"), (4, prose * 1 + "mail a.b@example.com now", "b"),
             (5, long, "b"), (None, prose + "and some more of this tale", None), (None, prose + "and some more of this tale", None),
             (6, " ".join(f"the w{i}" for i in range(300)), "c"), (6, "the same id of a text of ten other words or more", "c"), (7, "%%% " * 50, "c")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, ids array<int>, number int, digest map<string,int>"
    rows = [(i, t, None, s, 5, "x", [1, None], 2, {"k": 1}) for i, t, s in texts]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for df in (docs, docs.limit(0)):
        stage_in = df
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stored(stage(spark, stage_in, SF_SMALL), f"odd{at}")
            if at < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and out.schema["digest"].dataType == docs.schema["digest"].dataType
            stage_in = out
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in stage_in.collect())
        assert ids == ([] if df is not docs else [(False, 4), (False, 5), (False, 6), (False, 6), (True, 0)])
