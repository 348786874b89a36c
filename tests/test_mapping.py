import pytest
from conftest import executed_plan, optimized_plan
from pyspark.sql import functions as F

from tuneprep.operators import mapping
from tuneprep.plans import preference


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [(0, "q0", "a0", 5, "train"), (1, " \n", "a1", 6, "train"), (2, "q2", None, 7, "test")],
        "i int, instruction string, response string, other int, split string",
    )


def test_exactly_the_targets(raw):
    out = mapping.map_columns(raw, {"prompt": "instruction", "n": "other", "gone": "none"}, "i")
    assert out.columns == ["split", "i", "prompt", "n", "gone"]
    assert out.orderBy("i").first() == ("train", 0, "q0", "5", None)


def test_mapping_errors(raw):
    for column_map in ({}, {"a": "none", "b": "nothing"}):
        with pytest.raises(ValueError):
            mapping.map_columns(raw, column_map, "i")
    mapping.validate_mapping(raw, {"a": "none", "b": "response"})
    with pytest.raises(ValueError, match="must contain"):
        mapping.map_columns(raw, {"chosen": "response"}, "i", required=mapping.PAIR_COLUMNS)
    with pytest.raises(ValueError, match="collide"):
        mapping.map_columns(raw, {"i": "response"}, "i")
    with pytest.raises(ValueError, match="order columns"):
        mapping.map_columns(raw, {"a": "response"}, "nope")


def test_required_targets_only_in_fixed_order(raw):
    column_map = {"extra": "other", "rejected": "response", "chosen": "instruction"}
    out = mapping.map_columns(raw, column_map, "i", required=mapping.PAIR_COLUMNS)
    assert out.columns == ["split", "i", "chosen", "rejected"]


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, "x")], ["i", "a.b`c"])
    assert mapping.map_columns(df, {"t": "a.b`c"}, "i").first()["t"] == "x"


def test_drop_missing_needs_every_column(raw):
    mapped = mapping.map_columns(raw, {"p": "instruction", "r": "response"}, "i")
    assert [r["i"] for r in mapping.drop_missing(mapped, ["p", "r"]).collect()] == [0]


def test_filter_runs_at_the_scan_and_normalises_once(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    column_map = {"p": "instruction"}
    mapped = mapping.map_columns(spark.read.parquet(path), column_map, "i")
    out = mapping.normalize_columns(mapping.drop_missing(mapped, "p"), "p")
    assert "IsNotNull(instruction)" in executed_plan(out)
    assert optimized_plan(out).count("array_join(") == 1


def test_degenerate_pairs_are_compared_normalised_and_computed_once(spark):
    rows = [
        (0, "a", "a"), (1, "a", "A"), (2, "x \r\ny", "\tx\ny "), (3, "a", None), (4, None, "b"),
        (5, " ", "b"), (6, "p", "q"),
    ]
    df = spark.createDataFrame(rows, "i int, good string, bad string")
    out = preference.clean_pairs(df, {"chosen": "good", "rejected": "bad"}, "i")
    assert [tuple(r) for r in out.orderBy("i").collect()] == [(1, "a", "A"), (6, "p", "q")]
    assert optimized_plan(out).count("array_join(") == 2


def test_pair_dedup_key_is_checked(spark):
    df = spark.createDataFrame([(0, "a", "b")], "i int, chosen string, rejected string")
    same = {"chosen": "chosen", "rejected": "rejected"}
    with pytest.raises(ValueError, match="deduplicate"):
        preference.clean_pairs(df, same, "i", deduplicate="prompt")


def test_stateless_operators_run_on_a_stream(spark, raw, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    raw.write.parquet(source)
    from tuneprep.functions.sequences import attention_mask, completion_start
    from tuneprep.operators import sampling

    stream = spark.readStream.schema(raw.schema).parquet(source)
    mapped = mapping.map_columns(stream, {"chosen": "instruction", "rejected": "response"}, "i")
    clean = mapping.drop_degenerate_pairs(
        mapping.normalize_columns(mapping.drop_missing(mapped, ["chosen"]), ["chosen"])
    )
    ids = F.transform(F.split("chosen", ""), lambda c: F.ascii(c))
    out = sampling.hash_split(clean, 0.5, 42, "i").select(
        "i", "split", attention_mask(ids).alias("m"), completion_start(ids, [113]).alias("s")
    )
    query = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination(120)
    assert [(r["i"], r["s"]) for r in spark.read.parquet(sink).collect()] == [(0, 1)]
