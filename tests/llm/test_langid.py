import random
import zlib

from tuneprep.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"
SYLLABLES = {
    "en": "the ing tion er and th ou sh wh ly",
    "de": "ung keit sch der ein ß ü ä zu ver",
    "fr": "eau que é è ç tion ment la oi aux",
    "es": "ción ñ ll que do mente os ar ía ie",
    "qq": "xo zu ky ba kwa mbu ngo tzi lu ra",
}


def rows(n=600):
    rng = random.Random(1)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 4))) for _ in range(40)]
        out.append((i, " ".join(words), lang, "clash", 0))
    return out


def test_held_out_accuracy_and_edge_cases(spark):
    odd = [(9001, None, "en"), (9002, "", "en"), (9003, "12 34 !?", "de"), (None, "the thing and", None)]
    df = spark.createDataFrame(rows() + [(*r, None, None) for r in odd], SCHEMA)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == 604
    right = total = 0
    for i, _, lang, *_ in rows():
        held = zlib.crc32(str(i).encode()) % 5 == 0
        assert got[i].held_out == held and 0 <= got[i].score <= 1
        total += held
        right += held and got[i].lang_pred == lang
    assert right / total > 0.97
    for i in (9001, 9002, 9003):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[None].held_out and got[None].lang_pred == "en"
    kept = langid.drop_undetermined(df)
    assert kept.columns == df.columns and kept.count() == 601


def test_texts_alone_decide_and_labels_of_held_out_rows_are_not_used(spark):
    own = rows(300)
    other = [
        (i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s, h) for i, t, lang, s, h in own
    ]
    one, two = (
        sorted(map(tuple, langid.identify(spark.createDataFrame(x, SCHEMA)).collect()))
        for x in (own, other)
    )
    assert one == two


def test_empty_and_unlabelled_tables(spark):
    assert langid.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA)
    assert langid.identify(df).first().lang_pred == "und"
    one = spark.createDataFrame([(i, "some text", "en", None, None) for i in range(9)], SCHEMA)
    assert {r.lang_pred for r in langid.identify(one).collect()} == {"en"}


def test_rows_with_letters_stay_when_nothing_can_be_learned(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    odd = [(-1, None), (-2, ""), (-3, "12 !!")]
    for lang, ids in ((None, (1, 2, 3, None)), ("en", (held,))):
        own = [(i, "some text", lang, "s", 0) for i in ids]
        df = spark.createDataFrame(own + [(i, t, None, "s", 0) for i, t in odd], SCHEMA)
        kept = langid.drop_undetermined(df)
        assert kept.columns == df.columns
        assert sorted(map(str, kept.collect())) == sorted(map(str, df.filter("text = 'some text'").collect()))


def test_a_label_und_is_a_language(spark):
    df = spark.createDataFrame([(i, "some text", "und", "s", 0) for i in range(9)], SCHEMA)
    assert langid.drop_undetermined(df).count() == 9


def test_repeated_ids_give_the_same_model_twice(spark):
    """More rows than the sample holds, under few ids."""
    own = [(i % 9, text, lang, None, None) for i, text, lang, *_ in rows(300)]
    models = [
        langid.train(spark.createDataFrame(own, SCHEMA).repartition(n), sample_rows=50) for n in (1, 6)
    ]
    first, second = models
    assert first.families == second.families and (first.mean == second.mean).all()
    assert all((first.pair_weights[f] == second.pair_weights[f]).all() for f in first.pair_weights)
