import json

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from tuneprep import runtime
from tuneprep.sources import prepared, tables

ODD = 'a\nb "q" \\ \u2028 \u00e9\U0001f600 \t{x}'


@pytest.fixture
def clean(spark):
    rows = [("train", 1, ODD), ("train", 2, "two"), ("validation", 3, "three")]
    return spark.createDataFrame(rows, "split string, i bigint, prompt string")


SCHEMA = "i bigint, prompt string"
SPLITS = ["train", "validation"]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_round_trip(spark, clean, tmp_path, fmt):
    path = str(tmp_path / "p")
    assert prepared.write_prepared(clean, path, SPLITS, fmt) == SPLITS
    back = prepared.read_prepared(spark, path, SCHEMA, fmt)
    assert sorted(tuple(r) for r in back.select("split", "i", "prompt").collect()) == sorted(
        tuple(r) for r in clean.collect()
    )
    assert back.schema["split"].dataType.simpleString() == "string"
    assert "PartitionFilters: [isnotnull(split" in executed_plan(back.filter("split = 'train'"))


def test_json_lines_keep_non_ascii_raw(clean, tmp_path):
    prepared.write_prepared(clean, str(tmp_path / "p"), ["train"])
    text = "".join(f.read_text("utf-8") for f in (tmp_path / "p/split=train").glob("version=*/part-*"))
    assert "\u00e9\U0001f600" in text
    lines = [json.loads(line) for line in text.strip().split("\n")]
    assert sorted(line["i"] for line in lines) == [1, 2]
    assert {line["prompt"] for line in lines} == {ODD, "two"}


def test_finished_splits_are_skipped_one_by_one(spark, clean, tmp_path):
    path = str(tmp_path / "p")
    prepared.write_prepared(clean.filter("split = 'train'"), path, ["train"])
    assert prepared.pending_splits(spark, path, SPLITS) == ["validation"]
    changed = clean.withColumn("prompt", F.lit("changed"))
    assert prepared.write_prepared(changed, path, SPLITS) == ["validation"]
    back = {r["i"]: r["prompt"] for r in prepared.read_prepared(spark, path, SCHEMA).collect()}
    assert back == {1: ODD, 2: "two", 3: "changed"}


def test_skipping_runs_nothing(spark, clean, tmp_path):
    path = str(tmp_path / "p")
    prepared.write_prepared(clean, path, SPLITS)
    failing = clean.withColumn("prompt", F.raise_error(F.lit("ran")).cast("string"))
    assert prepared.write_prepared(failing, path, SPLITS) == []
    with pytest.raises(Exception, match="ran"):
        prepared.write_prepared(failing, path, SPLITS, if_exists="overwrite")


def test_interrupted_output_is_replaced(spark, clean, tmp_path):
    part = tmp_path / "p" / "split=train"
    part.mkdir(parents=True)
    (part / "part-0.json").write_text('{"i": 99, "prompt": "left over"}\n')
    assert prepared.write_prepared(clean, str(tmp_path / "p"), ["train"]) == ["train"]
    back = prepared.read_prepared(spark, str(tmp_path / "p"), SCHEMA)
    assert sorted(r["i"] for r in back.collect()) == [1, 2]


def test_other_modes(spark, clean, tmp_path):
    path = str(tmp_path / "p")
    prepared.write_prepared(clean, path, SPLITS)
    with pytest.raises(Exception, match="(?i)already.exists"):
        prepared.write_prepared(clean, path, SPLITS, if_exists="error")
    with pytest.raises(ValueError):
        prepared.write_prepared(clean, path, SPLITS, if_exists="append")
    changed = clean.withColumn("prompt", F.lit("new"))
    assert prepared.write_prepared(changed, path, SPLITS, if_exists="overwrite") == SPLITS
    assert {r["prompt"] for r in prepared.read_prepared(spark, path, SCHEMA).collect()} == {"new"}


def test_loading_splits(spark, tmp_path):
    train, test = str(tmp_path / "a.jsonl"), str(tmp_path / "b.parquet")
    (tmp_path / "a.jsonl").write_text('{"q": "x", "n": 1}\n{"q": "y"}\n')
    spark.createDataFrame([("z", 3)], "q string, n int").write.parquet(test)
    a = tables.load_split(spark, train, "train", schema="q string, n int")
    b = tables.load_split(spark, test, "test")
    assert sorted(tuple(r) for r in a.collect()) == [("x", 1, "train"), ("y", None, "train")]
    assert [tuple(r) for r in b.collect()] == [("z", 3, "test")]
    both = tables.load_splits(spark, {"train": test, "test": test})
    assert both.count() == 2
    assert executed_plan(both.filter("split = 'test'")).count("FileScan") == 1
    with pytest.raises(ValueError, match="schema"):
        tables.load_split(spark, train, "train")
    with pytest.raises(ValueError, match="format"):
        tables.load_split(spark, str(tmp_path / "c.xyz"), "train")
    with pytest.raises(ValueError):
        tables.load_splits(spark, {})


def test_shared_folder_comes_from_the_session(spark):
    assert runtime.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class _Session:
    """Just enough of a session to ask for the shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master, applicationId = "spark://host:7077", "app"


def test_a_cluster_needs_a_named_shared_folder(monkeypatch):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(_Session)
    monkeypatch.setattr(_Session.sparkContext, "master", "local[2]")
    assert runtime.shared_dir(_Session) == runtime.shared_dir(_Session)


def test_stored_row_order(spark, tmp_path):
    path = str(tmp_path / "rows.parquet")
    rows = [(f"t{i * 37 % 100}",) for i in range(100)]
    spark.createDataFrame(rows, "t string").coalesce(1).write.parquet(path)
    out = tables.load_split(spark, path, "train", row_order=True)
    assert list(tables.ROW_ORDER) == out.columns[1:3]
    ordered = out.repartition(5).orderBy(*tables.ROW_ORDER).collect()
    assert [r["t"] for r in ordered] == [t for (t,) in rows]
    with pytest.raises(ValueError, match="order column"):
        tables.load_split(spark, "x.jsonl", "train", schema="t string", row_order=True)


def test_a_finished_job_leaves_no_intermediate_tables(spark, tmp_path):
    from pathlib import Path

    from tuneprep.plans import instruction

    area = Path(runtime.shared_dir(spark)) / "tuneprep"
    before = set(area.glob("*"))
    rows = [("train", i, f"q{i % 3}", "a") for i in range(9)]
    raw = spark.createDataFrame(rows, "split string, i bigint, instruction string, response string")
    path = str(tmp_path / "p")
    instruction.prepare_instructions(
        raw, instruction.DEFAULT_COLUMN_MAP, "i", ["train"], path, "prompt"
    )
    back = prepared.read_prepared(spark, path, "i bigint, prompt string, response string")
    assert sorted(r["i"] for r in back.collect()) == [0, 1, 2]
    assert set(area.glob("*")) == before
    kept = runtime.materialize(back, "kept")
    assert kept.count() == 3 and set(area.glob("*")) != before


def test_split_names_read_back_as_they_were_from_one_pass(spark, tmp_path):
    names = ["a/b", "x=y", "50%", "two words", "train"]
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(i, names[i % 4]) for i in range(40)], "i int, split string")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows.mapInArrow(counted, rows.schema)
    path = str(tmp_path / "out")
    assert prepared.write_prepared(df, path, names) == names
    assert seen.value == 40
    out = prepared.read_prepared(spark, path, "i int")
    assert sorted((r["i"], r["split"]) for r in out.collect()) == [(i, names[i % 4]) for i in range(40)]
    assert prepared.write_prepared(df, path, names) == []
    assert prepared.write_prepared(df, path, [*names, "new"]) == ["new"]
    with pytest.raises(FileExistsError):
        prepared.write_prepared(df, path, names, if_exists="error")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.name[0] == "_") == ["_manifests"]


def contents(spark, path):
    return sorted(tuple(r) for r in prepared.read_prepared(spark, path, SCHEMA).select("split", "i", "prompt").collect())


@pytest.mark.parametrize("stop_in", ["rename", "_switch", "delete"])
def test_a_job_that_stops_leaves_the_old_or_the_new_data(spark, clean, tmp_path, monkeypatch, stop_in):
    """Stopped before the switch nothing has changed, stopped behind it everything has."""
    path = str(tmp_path / "p")
    prepared.write_prepared(clean, path, SPLITS)
    old = contents(spark, path)
    changed = clean.withColumn("prompt", F.lit("new"))

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(prepared, stop_in, stop)
        prepared.write_prepared(changed, path, SPLITS, if_exists="overwrite")
    new = sorted((s, i, "new") for s, i, _ in old)
    assert contents(spark, path) == (new if stop_in == "delete" else old)
    assert len(prepared.vacuum(spark, path)) == {"rename": 1, "_switch": 3, "delete": 3}[stop_in]
    assert prepared.vacuum(spark, path) == []
    assert contents(spark, path) == (new if stop_in == "delete" else old)
    prepared.write_prepared(changed, path, SPLITS, if_exists="overwrite")
    assert contents(spark, path) == new


def test_half_written_manifests_do_not_count(spark, clean, tmp_path):
    path = str(tmp_path / "p")
    prepared.write_prepared(clean, path, ["train"])
    (tmp_path / "p/_manifests/000000002.json").write_text('{"splits": {"tra')
    assert prepared.pending_splits(spark, path, SPLITS) == ["validation"]
    assert prepared.write_prepared(clean, path, SPLITS) == ["validation"]
    assert len(contents(spark, path)) == 3
    assert sorted(p.name for p in (tmp_path / "p/_manifests").glob("*.json"))[-1] == "000000003.json"


def test_writers_of_different_splits_keep_each_other(spark, clean, tmp_path, monkeypatch):
    """Another job's manifest appears between reading the last one and adding the next."""
    path = str(tmp_path / "p")
    read, raced = prepared._manifest, []

    def late(spark, at):
        seen = read(spark, at)
        if not raced:
            raced.append(1)
            prepared.write_prepared(clean, path, ["validation"])
        return seen

    prepared.write_prepared(clean.limit(0), path, ["other"])
    version = prepared.prepared_splits(spark, path)
    monkeypatch.setattr(prepared, "_manifest", late)
    replaced = prepared._switch(spark, path, {"train": {"folder": "split=train/version=x"}})
    assert replaced == {}
    assert set(prepared.prepared_splits(spark, path)) == {"train", "validation", "other"} > set(version)


def test_nothing_prepared(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        prepared.read_prepared(spark, str(tmp_path / "none"), SCHEMA)


def test_preparation_returns_its_counts(spark, tmp_path):
    from tuneprep.plans import instruction, preference

    rows = [("train", i, f"q{i % 20} ", " " if i % 9 == 0 else "a") for i in range(90)]
    rows += [("test", 90 + i, None if i < 3 else f"q{i}", "b") for i in range(10)]
    raw = spark.createDataFrame(rows, "split string, i bigint, instruction string, response string")
    path = str(tmp_path / "sft")
    args = (raw.repartition(7), instruction.DEFAULT_COLUMN_MAP, "i", ["train", "test", "empty"], path)
    done = instruction.prepare_instructions(*args, "prompt")
    whole = {q for s, _, q, a in rows if s == "train" and a.strip()}
    wanted = {
        "train": dict(rows_in=90, dropped_missing=10, dropped_degenerate=0, dropped_duplicates=80 - len(whole), rows_out=len(whole)),
        "test": dict(rows_in=10, dropped_missing=3, dropped_degenerate=0, dropped_duplicates=0, rows_out=7),
        "empty": dict.fromkeys(["rows_in", "dropped_missing", "dropped_degenerate", "dropped_duplicates", "rows_out"], 0),
    }
    assert done == ["train", "test", "empty"] and done.counts == wanted
    assert {s: e["counts"] for s, e in prepared.prepared_splits(spark, path).items()} == wanted
    again = instruction.prepare_instructions(*args, "prompt")
    assert again == [] and again.counts == {}

    pairs = spark.createDataFrame(
        [("train", i, f"c{i % 8}", f"c{i % 8}\n" if i % 4 == 0 else f"r{i}") for i in range(40)],
        "split string, i bigint, chosen string, rejected string",
    )
    done = preference.prepare_pairs(pairs, preference.DEFAULT_COLUMN_MAP, "i", ["train"], str(tmp_path / "dpo"), "chosen")
    assert done.counts["train"] == dict(rows_in=40, dropped_missing=0, dropped_degenerate=10, dropped_duplicates=24, rows_out=6)
    done = preference.prepare_pairs(pairs, preference.DEFAULT_COLUMN_MAP, "i", ["train"], str(tmp_path / "all"))
    assert done.counts["train"]["rows_out"] == 30 and done.counts["train"]["dropped_duplicates"] == 0


def test_exactly_the_mapped_columns_in_dataset_order(spark, tmp_path):
    from tuneprep.plans import instruction

    rows = [("train" if i % 4 else "test", i * 37 % 200, f"q{i}", f"a{i}") for i in range(200)]
    raw = spark.createDataFrame(rows, "split string, i bigint, instruction string, response string")
    path = tmp_path / "p"
    instruction.prepare_instructions(
        raw.repartition(6), instruction.DEFAULT_COLUMN_MAP, "i", ["train", "test"], str(path), only_mapped=True
    )
    for split in ("train", "test"):
        files = sorted((path / f"split={split}").glob("version=*/part-*"))
        lines = [json.loads(x) for f in files for x in f.read_text().split("\n") if x]
        wanted = [(q, a) for s, _, q, a in sorted(rows, key=lambda r: r[1]) if s == split]
        assert lines == [{"prompt": q, "response": a} for q, a in wanted]


def test_compressed_preparation_reads_back(spark, tmp_path):
    from tuneprep.plans import instruction

    rows = [("train", i, f"question {i} é " + "again and again " * 200) for i in range(50)]
    raw = spark.createDataFrame(rows, "split string, i bigint, text string").coalesce(1)
    sizes = {}
    for codec in (None, "gzip"):
        path = tmp_path / str(codec)
        instruction.prepare_instructions(raw, {"prompt": "text"}, "i", ["train"], str(path), compression=codec)
        files = list(path.glob("split=train/version=*/part-*"))
        sizes[codec] = sum(f.stat().st_size for f in files)
        assert files and all(f.name.endswith(".json.gz" if codec else ".json") for f in files)
        assert contents(spark, str(path)) == sorted((s, i, t.strip()) for s, i, t in rows)
    assert sizes["gzip"] * 10 < sizes[None]
