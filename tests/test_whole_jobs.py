"""Queries and operators on all rows, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tests.oracle import spark_rows, sql_rows
from tidemark.functions import clean
from tidemark.operators import matching, news, relational
from tidemark.plans import queries as _  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES


def brute_cover(pairs):
    of = {}
    for i, m in pairs:
        if i is not None and m is not None:
            of.setdefault(i, set()).add(m)
    out = []
    while any(of.values()):
        n, best = min((-len(ms), i) for i, ms in of.items())
        out.append((len(out) + 1, best, -n))
        gone = set(of[best])
        for ms in of.values():
            ms -= gone
    return out


@pytest.mark.parametrize("candidates, most", [((128, 16), 2**16), ((8, 2), 4)])
def test_greedy_cover_equals_brute_force(spark, monkeypatch, candidates, most):
    monkeypatch.setattr(relational, "CANDIDATES", candidates)
    monkeypatch.setattr(relational, "MOST_SETS", most)
    r = random.Random(4)
    pairs = [(r.randrange(30), int(r.random() ** 2 * 150)) for _ in range(250)] + [(None, 1), (7, None), (7, 1), (7, 1)]
    df = spark.createDataFrame(pairs, "q int, e long")
    assert [tuple(x) for x in relational.greedy_cover(df, "q", "e").orderBy("step").collect()] == brute_cover(pairs)


@pytest.mark.parametrize("most", [-1, 60, 10**6])
def test_greedy_cover_in_rounds_and_in_one_task(spark, monkeypatch, most):
    monkeypatch.setattr(relational, "CANDIDATES", (8, 2))
    monkeypatch.setattr(relational, "MOST_PAIRS", most)
    r = random.Random(5)
    pairs = [(f"q{r.randrange(20)}é" if r.random() < 0.5 else f"q{r.randrange(20)}Z", int(r.random() ** 2 * 90)) for _ in range(150)] + [(None, 1), ("q7Z", None)] * 2
    df = spark.createDataFrame(pairs, "q string, e long")
    assert [tuple(x) for x in relational.greedy_cover(df, "q", "e").orderBy("step").collect()] == brute_cover(pairs)


def test_greedy_cover_query_takes_all_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_orderkey").collect()
    got = QUERIES["greedy_cover"](spark, sf_dir).orderBy("step").collect()
    assert [tuple(x) for x in got] == brute_cover([tuple(x) for x in rows])


def expanded(rows):
    """All pairs of parts that the links of classes stand for."""
    of = {}
    for r in rows:
        if r["kind"] == "member":
            of.setdefault(r["unit"], []).append(r["id"])
    return [(a, b, r["distance"]) for r in rows if r["kind"] == "link" for a in of[r["id"]] for b in of[r["unit"]]]


def test_fuzzy_and_edit_match_take_all_names(spark, sf_dir):
    parts = [(k, n.lower()) for k, n in spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name").collect()]
    blocks = {}
    for k, n in parts:
        blocks.setdefault(k % 40, []).append((k, n))
    fuzzy, edit = set(), set()
    for k, n in parts:
        scores = {u: matching.ratio(n + "s", x) for u, x in blocks[k % 40]}
        best = min((-v, u) for u, v in scores.items())
        fuzzy.add((k, best[1], round(-best[0], 9)) if -best[0] >= 0.9 else (k, None, None))
        edit |= {(k, u, far) for u, x in blocks[k % 40] if (far := levenshtein(n + "s", x)) <= 3}
    got = QUERIES["fuzzy_match"](spark, sf_dir).collect()
    assert len(got) == len(parts) and {(r["id"], r["match_id"], r["match_score"] and round(r["match_score"], 9)) for r in got} == fuzzy
    got = expanded(QUERIES["edit_match_all"](spark, sf_dir).collect())
    assert len(got) == len(edit) and set(got) == edit


@pytest.mark.parametrize("most", [1, 3])
def test_edit_join_equals_brute_force(spark, most):
    r = random.Random(most)
    names = [(r.randrange(3), k, "".join(r.choice("abé") for _ in range(r.randrange(12)))) for k in range(150)]
    left, right = [*names[:90], (None, 901, "ab"), (1, 902, None), (1, 903, "")], [*names[40:], names[50], (None, 904, "ab"), (1, 905, None), (1, 906, "")]
    a = spark.createDataFrame(left, "b int, i long, x string")
    b = spark.createDataFrame(right, "b int, j long, y string")
    got = sorted(map(tuple, matching.edit_join(a, b, "b", "i", "x", "j", "y", most).collect()))
    near = [(i, j, levenshtein(x, y)) for p, i, x in left for q, j, y in right if p is not None and p == q and x is not None and y is not None]
    assert got == sorted(t for t in near if t[2] <= most)


def test_edit_match_all_lists_classes_not_copies(spark, tmp_path):
    names = ["Red bolt", "red BOLT", "red bolts", "red rod", "é", "", None]
    parts = [(k, names[(k // 40) % 7]) for k in range(0, 4000, 40)] + [(k, names[0]) for k in range(1, 4000, 40)] + [(None, "red bolt"), (7, "red rod"), (7, "red rod")]
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    known = [(k, n.lower()) for k, n in parts if k is not None and n is not None]
    least = {}
    for k, n in known:
        least[k % 40, n] = min(k, least.get((k % 40, n), k))
    near = [(k, u, far) for k, n in known for u, x in known if k % 40 == u % 40 and (far := levenshtein(n + "s", x)) <= 3]
    rows = QUERIES["edit_match_all"](spark, str(tmp_path)).collect()
    members = [(r["id"], r["unit"], r["distance"]) for r in rows if r["kind"] == "member"]
    assert sorted(members, key=str) == sorted(((k, least[k % 40, n.lower()] if k is not None and n is not None else None, None) for k, n in parts), key=str)
    assert len(rows) - len(members) == len({(a, b) for a in least.items() for b in least.items() if a[0][0] == b[0][0] and levenshtein(a[0][1] + "s", b[0][1]) <= 3})
    assert sorted(expanded(rows)) == sorted(near)


def test_edit_class_join_stands_for_all_pairs(spark):
    r = random.Random(7)
    names = [(r.randrange(2), k, "".join(r.choice("aé") for _ in range(r.randrange(7)))) for k in range(200)]
    left, right = [*names[:120], (None, 901, "ab"), (1, 902, None)], [*names[60:], names[70], (None, 904, "ab"), (1, 905, None)]
    a = spark.createDataFrame(left, "b int, i long, x string")
    b = spark.createDataFrame(right, "b int, j long, y string")
    links = [tuple(t) for t in matching.edit_class_join(a, b, "b", "i", "x", "j", "y", 2).collect()]
    of, to = ([tuple(t) for t in matching.key_classes(df, "b", i, k, "c").collect()] for df, i, k in ((a, "i", "x"), (b, "j", "y")))
    assert len(links) == len(set(links)) and len(of) == len(left) and len(to) == len(right)
    got = sorted((i, j, far) for p, q, far in links for i, c in of if c == p for j, d in to if d == q)
    near = [(i, j, levenshtein(x, y)) for p, i, x in left for q, j, y in right if p is not None and p == q and x is not None and y is not None]
    assert got == sorted(t for t in near if t[2] <= 2)


def articles(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = df.withColumn("title", F.split("text", "\n")[0]).withColumn("key", F.lower(clean.collapse("title")))
    return [r.asDict() for r in df.orderBy("doc_id").collect()]


def test_news_dedupe_keeps_all_but_repeats(spark, sf_dir):
    seen, want = set(), set()
    for r in articles(spark, sf_dir):
        keys = {(r["source"], "u", r["text"])} | ({(r["source"], "t", r["key"])} if r["key"] else set())
        if not keys & seen:
            seen |= keys
            want.add((r["doc_id"], r["title"]))
    got = [(r["doc_id"], r["title"]) for r in QUERIES["news_dedupe"](spark, sf_dir).collect()]
    assert len(got) == len(want) and set(got) == want


def test_prefer_direct_keeps_all_but_repeats(spark, sf_dir):
    names = ["FloodList", "ReliefWeb", "Google News (FloodList)", "Wikipedia", "GDACS"]
    priority = {r["n"]: r["p"] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", news.source_priority("n").alias("p")).collect()}
    rows = articles(spark, sf_dir)
    events_with_direct = {r["source"] for r in rows if r["doc_id"] % 5 == 0}
    kept, place = [], {}
    for r in rows:
        name = names[r["doc_id"] % 5]
        if name.startswith("Google") and r["source"] in events_with_direct:
            continue
        rank = priority[name] * 10_000 + (3 if r["n_chars"] > 2000 else 1) * 1_000 + r["n_chars"] % 10
        keys = [(r["source"], "t", r["key"])] * bool(r["key"]) + [(r["source"], "u", r["text"])]
        at = next((place[k] for k in keys if k in place), None)
        if at is None:
            at = len(kept)
            kept.append((rank, r["doc_id"]))
        elif rank > kept[at][0]:
            kept[at] = (rank, r["doc_id"])
        else:
            continue
        for k in keys:
            place[k] = at
    got = [r["doc_id"] for r in QUERIES["prefer_direct"](spark, sf_dir).collect()]
    assert len(got) == len(kept) and set(got) == {i for _, i in kept}


def test_quotes_are_counted_whole_and_without_inner_words(spark, tmp_path):
    long = "words of a quote that is longer than sixty characters, so that its end counts too"
    docs = [(1, "x " + long + " y"), (1, "x " + long[:70] + " no"), (None, "one 中文文本句 oneword"), (2, "two short words"), (2, "two short words"), (3, ""), (4, None)]
    items = [(1, long), (2, "中文文"), (3, "ewor"), (4, "two sho"), (5, ""), (6, None), (7, "o short w"), (8, " short "), (9, "absent"), (10, long)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    count = lambda q: sum(q is not None and t is not None and q in t for _, t in docs)
    got = dict(map(tuple, QUERIES["quote_support_all"](spark, str(tmp_path)).collect()))
    assert got == {i: count(q) for i, q in items} and got[1] == 1
    assert spark_rows(QUERIES["quote_support"](spark, str(tmp_path))) == sql_rows(ORACLES["quote_support"], str(tmp_path))


def test_quote_support_all_equals_brute_force(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    got = dict(map(tuple, QUERIES["quote_support_all"](spark, sf_dir).collect()))
    assert got == {i: sum(q in x for x in texts if x is not None) for i, q in items}


def test_chain_parse_takes_whole_turns(spark, tmp_path):
    turns = [(1, 1, "user", " " * 60 + "late words"), (1, 2, "user", "early words")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = [r.asDict() for r in QUERIES["chain_parse"](spark, str(tmp_path)).collect()]
    assert got == [{"conv_id": 1, "status": "parsed", "steps": 2, "validity": "valid"}]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar(text, value, threshold=0.86):
    """As said: the value is in the text, or its words or signs are nearly those of some words in a row."""
    if not value or value in text:
        return bool(value)
    words, own = text.split(), set(value.split())
    n = len(value.split())
    for size in range(max(1, n - 1), n + 4):
        for k in range(len(words) - size + 1):
            mine = set(words[k : k + size])
            if 2 * len(own & mine) >= threshold * (len(own) + len(mine)) or matching.ratio(value, " ".join(words[k : k + size])) >= threshold:
                return True
    return False


def test_terms_of_many_texts_at_once_equal_brute_force(monkeypatch):
    monkeypatch.setattr(matching, "_AT_ONCE", 200)
    r = random.Random(3)
    words = ["flood", "floods", "heavy", "rain", "flo", "od", "iran", "flash", "hevy", "é"]
    some = lambda most: " ".join(r.choice(words) for _ in range(r.randrange(most)))
    texts = [some(12) for _ in range(400)]
    terms = [[["heavy rain", "flash flood"]] * 400, [[some(4) for _ in range(r.randrange(3))] for _ in range(400)]]
    got = matching.similar_any(texts, terms)
    assert got == [[any(similar(t, v) for v in vs) for t, vs in zip(texts, values, strict=True)] for values in terms]
