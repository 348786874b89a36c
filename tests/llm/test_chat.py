from tuneprep.llm import chat

SCHEMA = f"pair_id long, chosen {chat.TURNS}, rejected {chat.TURNS}, prompt string, _pair string"


def brute(chosen, rejected):
    chosen, rejected = chosen or [], rejected or []
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def rendered(turns):
        out, spans = "", []
        for role, text in turns:
            out += f"<|{role or ''}|>\n"
            start = len(out)
            out += (text or "") + "\n"
            if role == "assistant":
                spans.append((start, len(out)))
        return out, spans

    prompt = rendered(chosen[:n])[0]
    return (prompt, *rendered(chosen[n:]), *rendered(rejected[n:]))


U, A = "user", "assistant"
PAIRS = [
    ([(U, "q"), (A, "good")], [(U, "q"), (A, "bad")]),
    ([(U, "q"), (A, "é\U0001f600"), (U, "more"), (A, "x" * 9000)], [(U, "q"), (A, "other")]),
    ([(U, "q"), (A, "same")], [(U, "q"), (A, "same")]),
    ([(U, "q")], [(U, "q"), (A, "only here")]),
    ([(U, "a")], [(U, "b")]),
    ([(None, None), (U, None), (A, None)], [(None, None), (U, ""), (A, "y")]),
    (None, [(A, "x")]),
    ([], None),
    ([("system", "s"), (A, "")], [("system", "s"), (A, "\n")]),
]


def test_pairs_are_formatted_as_by_hand(spark):
    df = spark.createDataFrame([(i, c, r, "clash", "clash") for i, (c, r) in enumerate(PAIRS)], SCHEMA)
    out = chat.format_preferences(df.union(df))
    rows = out.collect()
    assert len(rows) == 2 * len(PAIRS)
    for r in rows:
        spans = [[tuple(s) for s in x] for x in (r.chosen_spans, r.rejected_spans)]
        got = (r.prompt, r.chosen, spans[0], r.rejected, spans[1])
        assert got == brute(*PAIRS[r.pair_id])


def test_very_many_turns(spark):
    for n in (2, 3, 4, 5, 10, 17, 20_000):
        turns = [((U, A, None)[i % 3], "ab" * (i % 5)) for i in range(n)]
        df = spark.createDataFrame([(0, turns, [(U, "other")], None, None)], SCHEMA)
        r = chat.format_preferences(df).first()
        assert (r.chosen, [tuple(s) for s in r.chosen_spans]) == brute(turns, [(U, "other")])[1:3]


def test_pairs_of_conversations_and_odd_turns(spark):
    turns = [(0, 0, U, "q"), (0, 1, A, "r0"), (1, 0, U, "q1"), (1, 1, A, "r1"), (1, 2, U, "end"), (2, 0, U, "alone"), (4, 1, A, "r4"), (4, 0, None, None), (None, 0, A, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.pairs_of_conversations(df).collect()}
    assert [tuple(t) for t in got[0].rejected] == [(U, "q"), (A, "r1")]
    assert [tuple(t) for t in got[1].rejected] == [(U, "q1"), (A, "r0"), (U, "end")]
    assert got[2].rejected == got[2].chosen
    assert [tuple(t) for t in got[4].rejected] == [(None, None), (A, "")]
    assert [tuple(t) for t in got[None].rejected] == [(A, "")]


def test_empty_table_and_no_python(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = chat.format_preferences(empty)
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
