"""The pipeline on odd and real documents, stage by stage against what each stage is to do."""

from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest

from tuneprep.llm import mixing, pieces, secret_scan, simhash

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(
    not (DATA.exists() and Path(pieces.MODEL_FILE).exists()), reason="no test tables or model"
)


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(-1, None, "en", "src0", 0), (-2, "12 !!", None, None, 5), (None, "some words", None, None, None), (-3, "", None, "x", 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, str(DATA)).collect(), stage(spark, docs, str(DATA)).schema)
        seen[name] = docs.collect()
        assert docs.columns[: len(columns)] == columns
    first, second, third, fourth, last = seen.values()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r.doc_id for r in first} == {i for i, t in texts.items() if any(map(str.isalpha, t))} | {None}
    classes = {}
    for r in sorted(first, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        bits = simhash.fingerprint(r.text.encode(), 3) & (1 << 64) - 1
        near = [k for k in classes if (k ^ bits).bit_count() <= 2]
        merged = [x for k in near for x in classes.pop(k)] if near else []
        classes.setdefault(bits, merged).append(r.doc_id)
    assert len(second) == len(classes)
    assert {r.doc_id for r in third} == {r.doc_id for r in second}
    assert not any(secret_scan.base_spans(r.text) for r in third)
    assert all(r.n_chars == len(r.text) for r in third)
    third_df = spark.createDataFrame(third, first and spark.read.parquet(f"{DATA}/documents.parquet").schema)
    copies = {r.id: r.copies for r in mixing.copies(third_df).collect()}
    assert Counter(r.doc_id for r in fourth) == Counter({k: v for k, v in copies.items() if v})
    encoder = pieces.Encoder(pieces.load())
    assert all(r.piece_ids == encoder.encode([r.text])[0].tolist() for r in last)


def test_run_is_the_stages_in_order(spark):
    assert [name.split()[0] for name, _ in corpus_pipeline.STAGES] == [
        "language", "SimHash", "secret", "mixing", "SentencePiece",
    ]
    assert corpus_pipeline.run(spark, str(DATA)).count() > 100
