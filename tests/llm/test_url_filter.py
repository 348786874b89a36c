import math
import re
from collections import Counter
from functools import cache

import pytest

from tuneprep.llm import url_filter

SCHEMA = "page_id long, url string, html string, host string, rule int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def best_splits(letters, counts):
    """Every split of the letters, tried out; (score, words) of the most probable."""
    total, longest = sum(counts.values()), max(map(len, counts))

    def logp(word):
        if word in counts:
            return math.log10(counts[word]) - math.log10(total)
        return -math.log10(total) - len(word)

    @cache
    def best(rest):
        if not rest:
            return 0.0, ()
        found = []
        for n in range(1, min(longest, len(rest)) + 1):
            score, words = best(rest[n:])
            found.append((score + logp(rest[:n]), (rest[:n], *words)))
        return max(found)

    return best(letters)


WORDS = "the cheap pill pills casino win news blog free bet bets mail cloud sport en es www com net org example".split()
URLS = [
    "https://www.example.com/en/1", "https://Cheap-Pills.EXAMPLE.com/en/x?y=1", "http://example.com/en/", "http://example.com/en",
    "https://blog.casinowin.net/es/5.html#top", "https://blog.sportnews.net/en/7", "https://freebets.example.org/fr/9",
    "http://cloudmail.com/", "http://cloudmail.com", "http://cloudmail.com?x=/en/", "ftp://a.b.net/fr/1", "net/fr/1", "://net/es/",
    "https://notexample.com/en/1", "https://xn--bcher.example.net/es/\n2", "HTTP://ÄRGER.Example.COM/EN/", "http://h#frag/en", "",
    None, "https://user:pw@www.example.com:80/en/", "https://www.example.com/en/" + "word/" * 2000, "https://" + "casino" * 300 + ".org/de/",
]


def frame(spark, urls):
    page = "<html><style>zzz</style><script>if (a<b) yyy()</script><!-- xxx --><p class='qqq'>" + " ".join(WORDS * 40) + "&amp;"
    rows = [(i, u, page if i % 3 else None, "clash", 5) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, SCHEMA)


def test_same_as_brute_force(spark):
    urls = URLS * 2
    got = {r.page_id: r for r in url_filter.judge(frame(spark, urls)).collect()}
    assert len(got) == len(urls)
    split = [parts(u) for u in urls]
    counts = Counter()
    for i, (_, path) in enumerate(split):
        counts.update(re.findall(r"[^\W\d_]+", path.lower()))
        counts.update(WORDS * 40 if i % 3 else [])
    for host in {h for h, _ in split}:
        counts.update(re.findall(r"[^\W\d_]+", host.lower()))
    counts = {w: n for w, n in counts.items() if len(w) <= url_filter.LONGEST_WORD}
    segmenter = url_filter.Segmenter(dict(counts))

    def tokens(field, text):
        out = []
        for run in re.findall(r"[^\W\d_]+|\d+", text.lower()):
            if run.isdigit():
                out.append("#")
                continue
            words = segmenter.split(run)
            if len(run) < 40:
                score, best = best_splits(run, counts)
                mine = sum(segmenter.logp.get(w, 0) for w in words)
                if "?" not in words:
                    assert "".join(words) == run
                    assert mine == pytest.approx(score)
                else:
                    assert any(w not in counts for w in best)
            out += words
        return [f"{field}:{w}" for w in out]

    listed = [tokens("h", h) + tokens("p", p) for h, p in split]
    rules = [rule_of(h, p) for h, p in split]
    seen = {"allow": Counter(), "block": Counter()}
    for own, (_, verdict) in zip(listed, rules, strict=True):
        if verdict:
            seen[verdict].update(own)
    vocabulary = seen["allow"].keys() | seen["block"].keys()
    for i, (own, (rule, verdict)) in enumerate(zip(listed, rules, strict=True)):
        score = sum(
            math.log10((seen["block"][t] + 1) / (seen["block"].total() + len(vocabulary)))
            - math.log10((seen["allow"][t] + 1) / (seen["allow"].total() + len(vocabulary)))
            for t in own
            if t in vocabulary
        )
        row = got[i]
        assert (row.host, row.path, row.rule) == (*split[i], rule)
        assert row.score == pytest.approx(score, abs=1e-9)
        assert row.verdict == (verdict or ("block" if score > 0 else "allow"))
    assert {None, "com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/"} == {r for r, _ in rules}


def test_concatenated_names_are_split():
    segmenter = url_filter.Segmenter(dict.fromkeys(WORDS, 50))
    assert segmenter.split("freebets") == ["free", "bets"]
    assert segmenter.split("cheappills") == ["cheap", "pills"]
    assert segmenter.split("qqfreebets") == ["?", "free", "bets"]
    assert segmenter.tokens("Sport-News24_x.com") == ["sport", "news", "#", "?", "com"]
    assert url_filter.Segmenter({}).split("ab") == ["?", "?"]


def test_held_out_urls_of_the_rules_families():
    """Trained on most of the names, the model tells the rest by the words they are made of."""
    bad, good = ["casino", "bets", "pills"], ["news", "mail", "sport", "cloud"]
    segmenter = url_filter.Segmenter(dict.fromkeys([*bad, *good, *WORDS], 20))
    counts = {"block": Counter(), "allow": Counter()}
    names = [("block", a + b) for a in bad for b in bad] + [("allow", a + b) for a in good for b in good]
    for verdict, name in names[::2]:
        counts[verdict].update(url_filter.url_tokens(segmenter, f"{name}.org", "/en/1"))
    model = url_filter.Bayes.fit(counts)
    for verdict, name in names[1::2]:
        score = model.score(url_filter.url_tokens(segmenter, f"www.{name}.net", "/fr/2"))
        assert (score > 0) == (verdict == "block")


def test_empty_tables_and_no_training(spark):
    assert url_filter.judge(frame(spark, [])).collect() == []
    rows = url_filter.judge(frame(spark, [None, "http://a.org/x", "http://b.com/x"]), html_col=None).collect()
    assert sorted((r.page_id, r.rule, r.verdict, r.score) for r in rows) == [
        (0, None, "allow", 0.0), (1, None, "allow", 0.0), (2, "com/", "allow", 0.0)
    ]


def test_dictionary_is_bounded(spark):
    urls = spark.createDataFrame([("a.b", "/" + "x " * 64 + "y " * 32 + "z " * 32 + "q", None)], "host string, path string, html string")
    assert url_filter.unigrams(urls) == {"x": 64, "y": 32, "z": 32, "q": 1, "a": 1, "b": 1}
    assert url_filter.unigrams(urls, 3) == {"x": 64, "y": 32, "z": 32}
    assert url_filter.unigrams(urls, 2) == {"x": 64}
