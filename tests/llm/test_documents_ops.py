"""Operators on documents against brute force, on texts made to be awkward."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, grouping, jaccard_join, mixture, quality_rules, substring_dedup, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, name string, words string, hash string, size int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward():
    rng = np.random.default_rng(5)
    vocab = ["w%d" % i for i in range(300)] + ["été", "日本語", "a b", "x\x1cy"]
    make = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = make(120), make(60)
    rows = [(0, base), (1, base), (2, base + " tail"), (3, None), (4, ""), (5, "  \n\t "), (6, "one"), (7, "one"), (8, "ONE two"), (9, make(4)), (10, "a " * 500), (11, "a " * 90)]
    rows += [(20 + i, make(int(rng.integers(1, 200)))) for i in range(20)]
    rows += [(50 + i, make(30) + "\n" + passage + "\u000b" + make(25)) for i in range(8)]
    near = base.split()
    for i in range(12):
        edited = list(near)
        for at in rng.choice(len(edited), i, replace=False):
            edited[at] = "edit%d" % at
        rows.append((70 + i, " ".join(edited)))
    rows += [(90, " ".join(vocab * 40)), (91, "z" * 30_000), (92, passage)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = awkward()
    return spark.createDataFrame([(i, t, "en", "s%d" % (i % 3), 1, 7, "n", "w", "h", 3) for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_dedup(rows, size=20):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        ws = words(t)
        dead = [False] * len(ws)
        for p in range(len(ws) - size + 1):
            key = tuple(ws[p : p + size])
            if key in seen:
                dead[p : p + size] = [True] * size
            seen.add(key)
        kept = " ".join(w for w, x in zip(ws, dead, strict=True) if not x)
        out[i] = (len(ws), sum(dead), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_substring_dedup(docs):
    want = brute_dedup(awkward())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in substring_dedup.repeated_words(docs).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 500


@pytest.mark.parametrize("size,rounds", [(7, 2)])
def test_substring_dedup_other_sizes(docs, size, rounds):
    want = {k: v[:3] for k, v in brute_dedup(awkward(), size).items()}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.repeated_words(docs, size, rounds).collect()}
    assert got == want


def test_substring_dedup_repeated_rows_and_nulls(spark, empty):
    text = " ".join("v%d" % i for i in range(25))
    rows = [(None, text), (5, text), (5, text), (5, None), (None, None)]
    df = spark.createDataFrame([(i, t, None, None, None, 1, "", "", "", 1) for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in substring_dedup.repeated_words(df).collect())
    assert got == [(-1, 0, 0), (-1, 25, 0), (5, 0, 0), (5, 25, 25), (5, 25, 25)]
    assert substring_dedup.repeated_words(empty).collect() == []


def brute_components(rows, size=5, percent=75):
    sets = {}
    for i, t in rows:
        ws = words((t or "").translate(LOWER))
        sets[i] = {tuple(ws[p : p + size]) for p in range(len(ws) - size + 1)} if len(ws) >= size else ({tuple(ws)} if ws else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent", [75, 50])
def test_jaccard_components(docs, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs, 5, percent).collect()}
    assert got == brute_components(awkward(), 5, percent)


def test_jaccard_family_around_a_middle(spark):
    """Copies that are each like the first text, but not like one another; and a chain of links."""
    rng = np.random.default_rng(9)
    base = ["b%d" % i for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(40):
        edited = list(base)
        for at in rng.choice(200, 1 + i % 9, replace=False):
            edited[at] = "e%d_%d" % (i, at)
        rows.append((i, " ".join(edited)))
    chain = ["c%d" % i for i in range(100)]
    for i in range(10):
        rows.append((600 + i, " ".join(chain[8 * i : 8 * i + 60] + ["t"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect()}
    assert got == brute_components(rows)


def test_jaccard_nulls_and_repeats(spark, empty):
    t1, t2 = " ".join("a%d" % i for i in range(30)), " ".join("b%d" % i for i in range(30))
    rows = [(None, t1), (3, t1), (3, t2), (9, t2), (9, t2), (1, None), (7, t1.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect())
    assert got == [(-1, 26, None), (1, 0, 1), (3, 26, 3), (3, 26, 3), (7, 26, 3), (9, 26, 3), (9, 26, 3)]
    assert jaccard_join.jaccard_components(empty).collect() == []


def test_few_texts_are_picked_beside_those_wanted(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    picked, _ = jaccard_join._picked(docs, spark.range(0, 200_000, 4))
    got = {r["doc_id"] for r in picked.collect()}
    assert set(range(0, 200_000, 4)) <= got and len(got) < 52_000


def test_signatures_bound_intersections_from_above():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64)) for n in (1, 3, 40, 900, 1000)]
    sets += [np.sort(np.concatenate([s[: len(s) * k // 10], rng.integers(0, 1 << 48, len(s) // 3, dtype=np.uint64)])) for s in sets[2:] for k in (3, 6, 8, 9, 10)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sigs = [np.frombuffer(x, np.uint64) for x in jaccard_join._signatures(np.concatenate(sets), first)]
    for x, a in zip(sets, sigs):
        for y, b in zip(sets, sigs):
            assert jaccard_join._differing(a, b) <= len(np.setxor1d(x, y))
    assert jaccard_join._differing(sigs[3], sigs[4]) > 2 * 1900 // 7  # more than similar sets may differ in


def test_pairs_that_signatures_settle_send_no_texts(spark):
    texts = {i: " ".join(f"w{i}x{k}" for k in range(60)) for i in range(6)} | {6: " ".join(f"w0x{k}" for k in range(58))}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    sketches = docs.mapInArrow(jaccard_join._sketches(5), jaccard_join._SKETCH)
    tries = lambda wide: spark.createDataFrame([(0, wide, [(i, wide) for i in range(1, 7)])], "a long, wide double, bs array<struct<b:long,wide:double>>")
    left = lambda wide: sorted(b["b"] for r in jaccard_join._possible(tries(wide), sketches, 75).collect() for b in r["bs"])
    assert left(0.0) == [6] and left(0.5) == list(range(1, 7))  # of wide components members may be linked


def test_list_blocks_lose_no_pair():
    rng = np.random.default_rng(2)
    n = rng.integers(40, 400, 700)
    place = (rng.random(700) * n * 0.3).astype(np.int64)
    root = rng.integers(0, 500, 700)
    got = {tuple(p) for p in jaccard_join._list_pairs(root, n, place, 75).tolist()}
    want = set()
    for i in range(700):
        for j in range(i):
            (a, x, p), (b, y, q) = sorted(((int(n[k]), int(root[k]), int(place[k])) for k in (i, j)))
            if x != y and 100 * a >= 75 * b and min(a - p, b - q) * 175 >= 75 * (a + b):
                want.add((min(x, y), max(x, y)))
    assert got == want


def brute_hits(rows, items, size=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for item, t in items:
        ws = find(t)
        n = min(len(ws), size)
        for p in range(len(ws) - n + 1) if ws else ():
            windows.setdefault(tuple(ws[p : p + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, t in rows:
        ws, hit, names = find(t), set(), set()
        for n in lengths:
            for p in range(len(ws) - n + 1):
                if (key := tuple(ws[p : p + n])) in windows:
                    hit |= set(range(p, p + n))
                    names |= windows[key]
        names = sorted(str(x) for x in names if x is not None)
        out.append((i, len(ws), len(hit), len(names), tuple(names), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark, docs):
    rows = awkward()
    items = [(1, rows[0][1][100:400]), (2, rows[-1][1]), (3, None), (4, "!!"), (5, "One, TWO"), (6, "one"), (7, rows[-1][1]), (None, rows[20][1]), (1, rows[0][1][100:400])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in decontaminate.contamination(docs, bench).collect()]
    want = brute_hits(rows, items)
    assert sorted(got, key=repr) == want and sum(w[5] for w in want) > 5
    left = {r["doc_id"] for r in decontaminate.without_contaminated(docs, bench).collect()}
    assert left == {w[0] for w in want if not w[5]}


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, -1])
def test_decontamination_judges_each_row(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    rows = [(None, "clean one"), (None, "it says one two three here"), (None, "clean two"), (None, None), (7, "one two three"), (7, "clean three"), (8, ""), (8, "clean two")]
    df = spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "doc_id long, text string, extra int")
    left = decontaminate.without_contaminated(df, spark.createDataFrame([(1, "one two three")], "item_id long, text string"))
    assert left.columns == df.columns and sorted(r["extra"] for r in left.collect()) == [0, 2, 3, 5, 6, 7]


def test_decontamination_by_shuffle(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    bench = spark.createDataFrame([(1, awkward()[0][1])], "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_hit"]) for r in decontaminate.contamination(docs, bench).collect()))
    assert got == [(w[0], w[2]) for w in sorted(brute_hits(awkward(), [(1, awkward()[0][1])]))]


def test_decontamination_of_nothing(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(empty, none).collect() == []
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_words"] for r in decontaminate.contamination(twice, none).collect()) == [0, 2, 2]


def test_mixture(docs, spark):
    rows = {r["doc_id"]: r for r in mixture.mixed(docs).collect()}
    sizes = {i: len(words(t)) for i, t in awkward()}
    total = sum(sizes.values())
    by = {}
    for i, r in rows.items():
        assert r["size"] == sizes[i] and 0 <= r["taken"] <= 2 * sizes[i] and 0 <= r["position"]
        by.setdefault(r["source"], [0, r["target"], r["source_size"]])[0] += r["taken"]
    assert abs(sum(v[1] for v in by.values()) - 1.5 * total) < 1e-6 * total
    for taken, target, size in by.values():
        assert taken == int(target + 0.5) and target <= 2 * size + 1e-9
    again = {r["doc_id"]: r["taken"] for r in mixture.mixed(docs.repartition(3)).collect()}
    assert again == {i: r["taken"] for i, r in rows.items()}


def test_targets_are_those_of_repeated_sharing(spark):
    sizes = [("b", 10), ("a", 1000), ("d", 500), ("c", 30), (None, 0), ("e", 60)]
    got = {r["source"]: r["target"] for r in mixture.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    names = sorted((s for s, _ in sizes if s is not None)) + [None]
    weight, size = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, dict(sizes)
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(size.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2 * size[s]
                open_.remove(s)
    assert all(abs(got[s] - target[s]) < 1e-6 for s in names)


def test_positions_follow_the_schedule(spark):
    """Half of a rising source's words are asked for in the later part of training."""
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.mixed(df, weights=(1.0, 1.0), schedules=((1.0, 1.0, 1.0), (0.0, 1.0, 2.0)), total=1.0).collect()
    middle = {s: sorted(r["position"] for r in got if r["source"] == s)[100] for s in "ab"}
    assert abs(middle["a"] - 0.5) < 0.02 and abs(middle["b"] - 0.5**0.5) < 0.02
    assert all(0 <= r["position"] <= 1 for r in got)


def test_mixture_of_nothing(spark, empty):
    assert mixture.mixed(empty).collect() == []
    df = spark.createDataFrame([(None, None, None), (1, " ", None), (1, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"], r["copies"]) for r in mixture.mixed(df).collect()] == [(0, 0, 0)] * 3


def test_token_files(docs, empty, spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok, at, want = Tokenizer.from_file(public.path("word_bpe_49k.json")), 0, []
    for i, t in sorted(awkward(), key=lambda r: r[0]):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in token_files.token_digest(docs).collect()) == want
    assert token_files.token_digest(empty).collect() == []
    twice = spark.createDataFrame([(2, "b"), (None, "a"), (2, "b")], "doc_id long, text string")
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_files.token_digest(twice).collect())
    assert got == [(0, None, 2), (2, 2, 2), (4, 2, 2)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 2**32 - 1])
def test_segments_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    ids[::17] = top
    data, starts = token_files.pack_segment(ids)
    assert (token_files.unpack_segment(data) == ids).all() and len(starts) == -(-n // 256)


def test_words_are_encoded_as_the_library_does():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    tok, enc, rng = Tokenizer.from_file(path), token_files.Encoder(path), np.random.default_rng(4)
    signs = list("abzAZ09éÉßÇ×÷ªº,,..!?'\"-*  \n\t\x1c\x7f\x85\xa0€…“«»µİΣςñ̃<|")
    texts = ["".join(rng.choice(signs, int(rng.integers(0, 14)))) for _ in range(1500)] + ["don't it's <|endoftext|> <|ENDOFTEXT|> we'll,"]
    for text in texts:
        assert enc.encode([text.encode()])[0].tolist() == tok.encode(text, add_special_tokens=False).ids + [1], text


def test_quality_rules_on_held_out_labels(spark, sf_dir):
    more = sf_dir.replace("sf0.001", "sf0.01")  # the smallest tables have a dozen bad texts only
    sf_dir = more if os.path.isdir(more) else sf_dir
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_rules.scored(d, quality_rules.learn(d, labels))
    pairs = [(r["predicted"], r["quality"]) for r in out.filter("held_out").join(labels, "doc_id").collect()]
    assert pairs and sum(a == b for a, b in pairs) / len(pairs) > 0.95


def test_quality_rules_are_what_they_say(spark, docs):
    rules = quality_rules.Rules(-1.0, ((3.0, (("chars", True, 20.0),)), (-2.0, (("shouts", True, 0.0), ("chars", False, 100.0)))))
    rows = [(1, "short"), (2, "long enough to be over twenty"), (3, "long enough, but it shouts!!!"), (None, None), (2, "long enough to be over twenty")]
    df = spark.createDataFrame([(i, t, 0.0, "x") for i, t in rows], "doc_id long, text string, score double, predicted string")
    got = sorted((r["doc_id"] or -1, round(r["score"], 6)) for r in quality_rules.scored(df, rules).collect())
    f = lambda x: round(1 / (1 + np.exp(-x)), 6)
    assert got == [(-1, f(-1)), (1, f(-1)), (2, f(2)), (2, f(2)), (3, f(0))]


def test_quality_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_rules.scored(docs, quality_rules.learn(docs, none)).select("score").collect()} == {0.5}
    same = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, None, 0), (6, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    rules = quality_rules.learn(docs, same)
    assert rules.rules == () and rules.bias > 0
    assert quality_rules.scored(empty, rules).collect() == []


def test_held_out_is_the_remainder(spark):
    rows = [(i,) for i in range(50)] + [(None,)]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", quality_rules.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_quality_sample_bounds_rows(spark, monkeypatch):
    rows = [(1, f"text {i}") for i in range(60)] + [(3, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_rules, "fit_rules", lambda x, y, names, fold: seen.append(len(x)))
    quality_rules.learn(docs, labels, sample=5)
    assert seen == [5]


def test_each_word_meets_the_model_once():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, asked = token_files.Encoder(path), []
    model = encoder.model
    encoder.model = lambda word: asked.append(word) or model(word)
    texts = ["", "zarquonix Zarquonix frêle", "frêle ÀÉ zarquonix. naïveté", ""]
    for again in range(2):
        ids, each = encoder.encode([t.encode() for t in texts])
        said = [[*e.ids, token_files.END_ID] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [x for one in said for x in one] and each.tolist() == [len(one) for one in said]
    assert asked and len(asked) == len(set(asked))
    assert encoder.encode([])[0].tolist() == [] and encoder.encode([b""])[0].tolist() == [token_files.END_ID]


def test_another_tokenizer_gets_whole_texts(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer, normalizers

    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    other.normalizer = normalizers.NFC()
    other.save(f"{tmp_path}/t.json")
    texts = ["Hello  World", "", "x"]
    ids, sizes = token_files.Encoder(f"{tmp_path}/t.json").encode([t.encode() for t in texts])
    want = [[*other.encode(t, add_special_tokens=False).ids, token_files.END_ID] for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_encoder_that_forgets(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_files, "REMEMBERED", 20_000)
    rng = np.random.default_rng(0)
    texts = [" ".join("".join(rng.choice(list("abcdeé-'"), 5)) for _ in range(200)).encode() for _ in range(12)]
    e = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for t in [*texts, *texts]:
        ids, _ = e.encode([t])
        assert ids.tolist() == [*e.tokenizer.encode(t.decode(), add_special_tokens=False).ids, token_files.END_ID]


def peak_mb(f):
    """What ``f`` returns, and the most that Python and NumPy held meanwhile beyond what was there."""
    import tracemalloc

    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_encoder_goes_when_files_are_read():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    token_files.encoder(path)
    assert token_files.encoder.cache_info().currsize
    assert list(token_files._unpacked(iter(()))) == []
    assert not token_files.encoder.cache_info().currsize


def test_encoder_of_bounded_memory():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    texts = [" ".join(f"word{i}x{j}" for j in range(300)).encode() for i in range(60)]
    small, large = token_files.Encoder(path, 100_000), token_files.Encoder(path)
    for t in texts:
        assert small.encode([t])[0].tolist() == large.encode([t])[0].tolist()
    assert len(small.known) + len(small.older[0]) < 1500 < 10_000 < len(large.known)


def test_encoder_starts_small():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    e, mb = peak_mb(lambda: token_files.Encoder(path))
    assert e.split and mb < 10


def test_sketches_hold_little():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 1000).tolist())) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows, mb = peak_mb(lambda: sum(len(x) for x in jaccard_join._sketches(5)(iter([batch]))))
    assert rows >= 600 and mb < 40


def test_driver_has_the_command_to_trim(spark):
    assert grouping.trim_driver(spark)


def test_each_table_written_trims_the_driver(spark, monkeypatch):
    trimmed = []
    monkeypatch.setattr(grouping, "trim_driver", trimmed.append)
    assert grouping.materialised(spark.range(10), "some").count() == 10
    assert trimmed == [spark]


def test_driver_without_the_command_is_left_alone():
    class Elsewhere:
        @property
        def _jvm(self):
            raise AttributeError("no JVM here")

    assert not grouping.trim_driver(Elsewhere())
