import os
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tuneprep.functions import sequences as seq
from tuneprep.operators import batching, placement, pairs, tokens
from tuneprep.plans import instruction


def reference_start(ids, pattern):
    text = "," + ",".join(map(str, ids)) + ","
    wanted = "," + ",".join(map(str, pattern)) + ","
    at = text.find(wanted) if pattern else -1
    return 0 if at < 0 else text[: at + 1].count(",") - 1 + len(pattern)


@pytest.fixture(scope="module")
def sequences(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randint(1, 4) for _ in range(rng.randint(0, 12))]) for i in range(1000)]
    return rows, spark.createDataFrame(rows, "i int, input_ids array<int>")


@pytest.mark.parametrize("pattern", [[], [1], [2, 3], [1, 1], [1, 2, 1], [4] * 20, [9]])
def test_completion_start(sequences, pattern):
    rows, df = sequences
    out = df.select("i", seq.completion_start(F.col("input_ids"), pattern).alias("s"))
    out = out.withColumn("f", seq.tag_found(F.col("s"))).orderBy("i").collect()
    for (_, ids), r in zip(rows, out):
        start = reference_start(ids, pattern)
        assert (r["s"], r["f"]) == (start, start > 0)


def collated(rows, size, pad, pattern, mask_padding=False):
    out = {}
    for b in range(0, len(rows), size):
        batch = rows[b : b + size]
        width = max(len(ids) for _, ids in batch)
        for place, (i, ids) in enumerate(batch):
            missing = width - len(ids)
            start = reference_start(ids, pattern)
            padded = ids + [pad] * missing
            labels = [-100] * start + padded[start:]
            if mask_padding:
                labels = labels[: len(ids)] + [-100] * missing
            mask = [1] * len(ids) + [0] * missing
            out[i] = (b // size, place, padded, mask, labels, len(ids), start > 0)
    return out


@pytest.mark.parametrize("indexed", [False, True])
@pytest.mark.parametrize("mask_padding", [False, True])
def test_collate_like_a_plain_loop(sequences, indexed, mask_padding):
    rows, df = sequences
    df = df.repartition(5)
    if indexed:
        df = placement.with_index(df, "i")
    out = batching.collate(df, 6, 4, "i", [2, 3], mask_padding).collect()
    got = {
        r["i"]: (
            r["batch_id"], r["pos_in_batch"], r["input_ids"], r["attention_mask"], r["labels"],
            r["n_tokens"], r["tag_found"],
        )
        for r in out
    }
    assert got == collated(rows, 6, 4, [2, 3], mask_padding)


def test_given_masks_are_kept(spark):
    rows = [(0, [5, 6], [0, 1]), (1, [7, 8, 9], None)]
    df = spark.createDataFrame(rows, "i int, input_ids array<int>, attention_mask array<int>")
    out = batching.pad_batch(df, 2, 0, "i").orderBy("i").collect()
    assert [r["attention_mask"] for r in out] == [[0, 1, 0], [1, 1, 1]]
    with pytest.raises(ValueError):
        batching.pad_batch(df, 0, 0, "i")
    with pytest.raises(ValueError):
        seq.completion_labels(F.col("input_ids"), F.lit(0), mask_padding=True)


def test_special_ids():
    assert tokens.resolve_special_ids(None, 2) == (2, 2)
    assert tokens.resolve_special_ids(0, 2) == (0, 2)
    assert tokens.resolve_special_ids(0, None) == (0, None)
    with pytest.raises(ValueError):
        tokens.resolve_special_ids(None, None)


TEXTS = ["b a b", "  a\u2003c\n", "", None, "b <pad> a", "zz \x1f yy", " \n "]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")


def test_vocabulary_ranks_and_reserves(corpus):
    vocab = tokens.build_vocab(corpus, "t", 3).orderBy("token_id").collect()
    assert [(r["token"], r["token_id"], r["n"]) for r in vocab[4:]] == [
        ("a", 4, 3), ("b", 5, 3), ("c", 6, 1),
    ]
    assert [r["token"] for r in vocab[:4]] == list(tokens.SPECIAL_TOKENS)
    with pytest.raises(ValueError):
        tokens.build_vocab(corpus, "t", 0)


@pytest.mark.parametrize("max_len", [1, 2, 50])
def test_encode_like_a_plain_loop(corpus, max_len):
    vocab = tokens.build_vocab(corpus, "t", 3)
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    encoder = tokens.WordEncoder(vocab)
    for bos in (None, tokens.BOS_ID):
        out = tokens.encode(corpus.repartition(3), "t", encoder, max_len, "i", bos).collect()
        assert len(out) == len(TEXTS)
        for r in out:
            words = (TEXTS[r["i"]] or "").split()
            wanted = [ids.get(w, tokens.UNK_ID) for w in words]
            wanted = (([bos] if bos is not None else []) + wanted)[:max_len]
            assert r["input_ids"] == wanted
            assert r["attention_mask"] == [1] * len(wanted)
    assert tokens.encode_literal(encoder, "a b") == [ids["a"], ids["b"]]


def test_encoder_on_sliced_and_empty_batches(corpus):
    encoder = tokens.WordEncoder(tokens.build_vocab(corpus, "t", 3))
    whole = encoder(pa.array(TEXTS, pa.string())).to_pylist()
    assert encoder(pa.array(["x", *TEXTS], pa.string())[1:]).to_pylist() == whole
    assert encoder(pa.array([], pa.string())).to_pylist() == []


def test_arrow_splits_where_python_does():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    counts = pc.list_value_length(tokens._split(pa.array([f"a{c}b" for c in every])))
    assert counts.to_pylist() == [len(f"a{c}b".split()) for c in every]


def test_instruction_plan_end_to_end(spark, tmp_path):
    rows = [(i, "train", f"q{i % 40}  \n", f"a{i} word") for i in range(100)]
    rows += [(100, "train", " ", "x"), (101, "validation", "q1", "y")]
    raw = spark.createDataFrame(rows, "i bigint, split string, instruction string, answer string")
    column_map = {"prompt": "instruction", "response": "answer"}
    path = str(tmp_path / "prepared")
    written = instruction.prepare_instructions(
        raw, column_map, "i", ["train", "validation"], path, deduplicate="prompt"
    )
    assert written == ["train", "validation"]
    from tuneprep.sources.prepared import read_prepared

    prepared = read_prepared(spark, path, "i bigint, prompt string, response string")
    assert prepared.filter("split = 'train'").count() == 40
    texts = instruction.assemble_instructions(
        prepared, instruction.ROLE_TAG_TEMPLATE, "i", limit=20
    )
    train = texts.filter("split = 'train'")
    assert train.count() == 20 and texts.columns == ["split", "i", "prompt"]
    encoder = tokens.WordEncoder(tokens.build_vocab(train, "prompt", 100))
    stored = instruction.tokenize_instructions(train, "prompt", encoder, "i")
    batches = instruction.batch_instructions(
        stored, encoder, "i", tokens.PAD_ID, instruction.ROLE_TAG_COMPLETION
    )
    rows = batches.collect()
    assert sorted({r["batch_id"] for r in rows}) == [0, 1, 2, 3]
    assert all(r["tag_found"] and r["labels"][: r["completion_start"]] == [-100] * 3 for r in rows)


def test_common_prompt(spark):
    rng = random.Random(2)
    rows = []
    for i in range(800):
        common = "".join(rng.choices("ab\u00e9\U0001f600#", k=rng.randint(0, 9)))
        rest = ["".join(rng.choices("ab\U0001f600#", k=rng.randint(0, 5))) for _ in range(2)]
        rows.append((i, common + rest[0], common + rest[1]))
    rows.append((800, "x" * 200_000 + "a", "x" * 200_000 + "b"))
    df = spark.createDataFrame(rows, "i int, chosen string, rejected string")
    plain = pairs.split_common_prompt(df).orderBy("i").collect()
    marked = pairs.split_common_prompt(df, "#").orderBy("i").collect()
    for (_, c, r), p, m in zip(rows, plain, marked):
        common = os.path.commonprefix([c, r])
        assert (p["prompt"], p["chosen"], p["rejected"]) == (
            common, c[len(common) :], r[len(common) :],
        )
        cut = common[: common.rfind("#") + 1]
        assert (m["prompt"], m["chosen"], m["rejected"]) == (cut, c[len(cut) :], r[len(cut) :])


def test_truncate_pair(spark):
    rows = [
        (p, c, r) for p in range(6) for c in range(6) for r in range(6)
    ]
    df = spark.createDataFrame(
        [(list(range(p)), list(range(c)), list(range(r))) for p, c, r in rows],
        "prompt_ids array<int>, chosen_ids array<int>, rejected_ids array<int>",
    )
    for max_prompt, max_len in ((0, 0), (0, 3), (2, 4), (3, 3), (10, 20)):
        out = pairs.truncate_pair(df, max_prompt, max_len)
        for r, (p, c, j) in zip(out.collect(), rows):
            prompt = list(range(p))[max(p - max_prompt, 0) :]
            room = max_len - len(prompt)
            assert tuple(r) == (prompt, list(range(c))[:room], list(range(j))[:room])
    with pytest.raises(ValueError):
        pairs.truncate_pair(df, 5, 4)


def test_null_or_repeated_order_keys_are_an_error(spark):
    from tuneprep.operators import batching, placement

    for keys in ([1, 1, 2], [1, None, 2]):
        df = spark.createDataFrame([(k, [1]) for k in keys], "k int, input_ids array<int>")
        with pytest.raises(Exception, match="unique and not null"):
            placement.with_index(df, "k").collect()
        with pytest.raises(Exception, match="unique and not null"):
            batching.pad_batch(df, 2, 0, "k").collect()


def test_index_and_batches_are_those_of_each_split(spark):
    from tuneprep.operators import batching, placement

    rows = [(i, "train" if i % 3 else "test", [1] * (i % 7 + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, split string, input_ids array<int>").repartition(4)
    own = {s: [r for r in rows if r[1] == s] for s in ("train", "test")}
    got = {r["k"]: r["idx"] for r in placement.with_index(df, "k").collect()}
    assert got == {r[0]: n for part in own.values() for n, r in enumerate(part)}
    for r in batching.pad_batch(df, 4, 0, "k").collect():
        place = [x[0] for x in own[r["split"]]].index(r["k"])
        assert (r["batch_id"], r["pos_in_batch"]) == (place // 4, place % 4)
        batch = own[r["split"]][place // 4 * 4 : place // 4 * 4 + 4]
        assert len(r["input_ids"]) == max(len(x[2]) for x in batch)


@pytest.mark.parametrize("max_len", [0, 1, 3, 1 << 20])
@pytest.mark.parametrize("bos", [None, 2])
def test_encoding_by_join_equals_encoding_by_worker(spark, corpus, max_len, bos):
    """Whole vocabularies and short ones, empty and null texts, batches of two rows."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        for vocab in (tokens.full_vocab(corpus, "t"), tokens.build_vocab(corpus, "t", 2)):
            encoder = tokens.WordEncoder(vocab)
            wanted = tokens.encode(corpus, "t", encoder, max_len, "i", bos)
            got = tokens.encode_by_join(corpus, "t", vocab, max_len, "i", bos)
            assert got.columns == wanted.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        kept = tokens.encode_by_join(corpus, "t", vocab, 5, "i", keep=["t"])
        assert kept.columns == ["i", "t", "input_ids", "attention_mask"]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_full_vocabulary_ranks_every_token(spark, corpus):
    whole = [tuple(r) for r in tokens.full_vocab(corpus, "t").orderBy("token_id").collect()]
    assert whole == [tuple(r) for r in tokens.build_vocab(corpus, "t", 10_000).orderBy("token_id").collect()]
    empty = tokens.full_vocab(corpus.limit(0), "t").collect()
    assert [r["token"] for r in empty] == list(tokens.SPECIAL_TOKENS)
    twice = tokens.full_vocab(corpus, "t").union(spark.createDataFrame([(whole[5][0], 99, 1)], "token string, token_id int, n bigint"))
    with pytest.raises(Exception, match="lists a token twice"):
        tokens.encode_by_join(corpus, "t", twice, 9, "i").collect()


def test_long_texts_are_split_a_few_megabytes_at_a_time(spark, monkeypatch):
    """A worker holds the words of a bounded stretch of a batch, and the rows stay as they are."""
    texts = ["a b a"] * 2000 + ["", None] + ["b " * 300_000] * 24 + ["c"] * 7
    sizes, split = [], tokens._split
    monkeypatch.setattr(tokens, "_split", lambda t: sizes.append(t.slice(0).nbytes) or split(t))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    counts = {}
    for out in tokens._count_words(iter([batch])):
        for word, n in zip(*(c.to_pylist() for c in out.columns)):
            counts[word] = counts.get(word, 0) + n
    assert {w: n for w, n in counts.items() if w} == {"a": 4000, "b": 2000 + 24 * 300_000, "c": 7}
    assert len(sizes) > 1 and max(sizes) < 2 * tokens._BLOCK_BYTES < batch.nbytes
    monkeypatch.undo()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    vocab = tokens.build_vocab(df, "text", 10)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    for out in (
        tokens.encode(df, "text", tokens.WordEncoder(vocab), 4, "i"),
        tokens.encode_by_join(df, "text", tokens.full_vocab(df, "text"), 4, "i"),
    ):
        got = [r["input_ids"] for r in out.orderBy("i").collect()]
        assert got == [[ids[w] for w in (t or "").split()[:4]] for t in texts]
