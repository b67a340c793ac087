"""The corpus operators against brute force on small frames with nulls, empty texts, repeated rows and odd columns."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalframe.llm.chat import canonical, link_calls
from vitalframe.llm.decontaminate import find_leaks
from vitalframe.llm.jaccard import _comparing, bands, near_copies
from vitalframe.llm.langid import identify, learn_filter
from vitalframe.llm.mixing import curriculum, mix
from vitalframe.llm.ppm import score_texts
from vitalframe.llm.rpforest import near_vectors
from vitalframe.llm.sharding import min_cost_flow, reshard, rewrite_affected
from vitalframe.llm.substrings import remove_repeats
from vitalframe.llm.text import SLAB_BYTES
from vitalframe.llm.toxicity import score_toxicity

rng = random.Random(5)
VOCAB = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(n=60, length=40):
    """(doc_id, text, source): random texts, near and exact copies, nulls, empties, a long one, a repeated row."""
    out, base = [], []
    for i in range(n):
        if base and rng.random() < 0.5:
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
        else:
            w = [rng.choice(VOCAB) for _ in range(rng.randrange(1, length * 2))]
            base.append(w)
        out.append((i, rng.choice([" ", "\n", "  "]).join(w), rng.choice(["a", "b", None])))
    out += [(n, None, "a"), (n + 1, "", None), (n + 2, " \t\n", "b"), (n + 3, "one two", "a"), (n + 4, "one two", "b")]
    out += [(n + 5, " ".join(rng.choice(VOCAB) for _ in range(5000)), "c"), out[3], (None, "who am i " * 9, "a")]
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({"rep": F.lit(1), "bucket": F.lit("x"), "size": F.lit(None).cast("int"), "a": F.lit(2.0)})


def shingles(text, k):
    w = words(low(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def smallest_reachable(ids, links):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(best[a], best[b])
            if best[a] != m or best[b] != m:
                best[a] = best[b] = m
                changed = True
    return best


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_near_copies(docs, rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t, _ in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a < b and x and 100 * len(x & y) >= percent * len(x | y)]
    best = smallest_reachable({i for i, _ in sets if i is not None}, links)
    want = Counter((i, len(x), best.get(i)) for i, x in sets)
    assert Counter(map(tuple, near_copies(docs, k, percent).collect())) == want
    assert links


def test_near_copies_hot_group(spark):
    """A large group of near copies whose members mostly don't link with each other."""
    base = [f"x{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        w = list(base)
        for j in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            w[j] = f"y{i}-{j}"
        rows.append((i, " ".join(w)))
    sets = [(i, shingles(t, 3)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 90 * len(x | y)]
    best = smallest_reachable(range(90), links)
    got = {r.doc_id: r.component_id for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == best and len(set(best.values())) > 2


def test_near_copies_in_groups_headed_by_excerpts(spark):
    """Two near copies whose every common group has a smallest member that fits neither of them."""
    rng = random.Random(5)
    common = [f"w{i}" for i in range(102)]
    rows = [(i, " ".join(rng.sample(common, 86))) for i in range(300)]
    rows += [(1000, " ".join([*common, "b"])), (1001, " ".join([*common, "c"]))]
    got = {r.doc_id: r.component_id for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90).collect()}
    assert (got[1000], got[1001]) == (1000, 1000)


def test_near_copies_of_texts_over_a_slab(spark):
    """A text longer than a slab is hashed like any other, and the session's batch setting is put back."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    long = " ".join(f"word{i}" for i in range(60_000))
    assert len(long) > SLAB_BYTES
    frame = spark.createDataFrame([(1, "start " + long), (2, long + " end"), (3, long[: SLAB_BYTES // 2]), (4, "word1 word2 word3")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(frame, 3, 90).collect()}
    half = len(words(long[: SLAB_BYTES // 2]))
    assert got == {1: (59_999, 1), 2: (59_999, 1), 3: (half - 2, 3), 4: (1, 4)}
    assert spark.conf.get(setting) == before


def test_bands_keep_linked_sizes_together():
    plan = bands(5000, 80)
    assert [b.low for b in plan][0] == 1 and all(a.high + 1 == b.low for a, b in zip(plan, plan[1:]))
    assert all(b.n1 > (2 * b.high * 20 // 180) // (b.k2 + 1) for b in plan)


def test_remove_repeats(docs, rows):
    k = 5
    first = {}
    for i, t, _ in rows:
        w = words(t)
        for j in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[j : j + k])
                first[key] = min(first.get(key, i), i)
    want = Counter()
    for i, t, _ in rows:
        w = words(t)
        gone = {x for j in range(len(w) - k + 1) if i is not None and first[tuple(w[j : j + k])] < i for x in range(j, j + k)}
        want[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    got = remove_repeats(docs, k).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_removed for r in got)
    assert any(r.n_removed for r in got)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_find_leaks(spark, docs, rows, block_bytes):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    tests = [(1, " ".join(words(rows[4][1])[:8])), (2, "One, two!"), (3, None), (None, "one two"), (4, "..."), (2, "zzz"), (10, "who am")]
    bench = spark.createDataFrame(tests, "item_id long, text string").withColumn("hash", F.lit(0))
    windows = {}
    for i, t in tests:
        w = split(t)
        if i is not None and w:
            for j in range(max(1, len(w) - 5)):
                windows.setdefault(tuple(w[j : j + 6]), set()).add(str(i))
    want = Counter()
    for i, t, _ in rows:
        w, hit, items = split(t), set(), set()
        for key, ids in windows.items():
            for j in range(len(w) - len(key) + 1):
                if tuple(w[j : j + len(key)]) == key:
                    hit |= set(range(j, j + len(key)))
                    items |= ids
        want[i, len(w), len(hit), tuple(sorted(items))] += 1
    got = find_leaks(docs, bench, k=6, block_bytes=block_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    assert all(len(split(r.clean)) == r.n_words - r.n_hit for r in got)


def test_mix(docs, rows):
    got = mix(docs).collect()
    by = Counter()
    for _, t, s in rows:
        by[s] += len(words(t))
    order = sorted(by, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(by.values()), {}, set(by)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * by[s]}
        if not over:
            break
        target |= {s: 2.0 * by[s] for s in over}
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in rows)
    for s in by:
        own = [r for r in got if r.source == s]
        assert all(math.isclose(r.target, target[s]) for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 1
        assert all(r.taken <= 2 * r.size for r in own)
    read = curriculum(mix(docs)).collect()
    at = [r.position for r in read]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    assert sum(r.words for r in read) == sum(r.taken for r in got)


def test_curriculum_follows_schedule(spark):
    """A rising source comes late on average, a falling one early."""
    df = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    read = curriculum(mix(df, weights=(1.0, 1.0), shapes=((0.0, 2.0), (2.0, 0.0)))).groupBy("source").agg(F.avg("position").alias("p")).collect()
    mean = {r.source: r.p for r in read}
    assert abs(mean["a"] - 2 / 3) < 0.02 and abs(mean["b"] - 1 / 3) < 0.02


def test_min_cost_flow():
    flow = min_cost_flow([10, 0, 5], [4, 6, 5], 1.0 - np.eye(3))
    assert flow.sum(1).tolist() == [10, 0, 5] and flow.sum(0).tolist() == [4, 6, 5]
    assert flow[0, 0] == 4 and flow[2, 2] == 5
    # Going round by way of a cheap edge beats the dear direct one.
    assert min_cost_flow([2, 2], [2, 2], np.array([[1.0, 5.0], [1.0, 2.0]])).tolist() == [[2, 0], [0, 2]]


def test_reshard(spark, docs, tmp_path):
    big = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 30)).otherwise(F.repeat(F.col("id").cast("string"), 9)).alias("text")
    )
    both = docs.select("doc_id", "text").union(big)
    text = F.coalesce("text", F.lit(""))
    out = reshard(both, F.octet_length(text) + 1, F.xxhash64(text), F.pmod(F.xxhash64(text), F.lit(3)), shards=5).cache()
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(map(tuple, both.collect()))
    sizes, slots, homes = Counter(), {}, {}
    for r in got:
        sizes[r.shard] += len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(r.text, set()).add(r.shard)
    longest = max(len((r.text or "").encode()) for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert [t for t, s in homes.items() if len(s) > 1] in ([], ["hot " * 30])
    rewrite_affected(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == sum(1 for r in got if r.shard in {x for q in got if q.shard != q.old_shard for x in (q.shard, q.old_shard)})


def test_score_texts(spark, docs, rows):
    held = F.col("doc_id") % 3 == 1
    got = score_texts(docs, held, order=2).collect()
    train = [t for i, t, _ in rows if i is None or i % 3 != 1]
    count = Counter(w for t in train for w in [*words(low(t)), None])
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words(low(t)), None])
    want = sorted((str(i), len(words(t)) + 1, sum(count[w] > 0 for w in [*words(low(t)), None]), round(base(t), 6)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    # Brute force: contexts of two bytes at most, seen bytes excluded after an escape; escapes as the model learnt them.
    grams = [Counter(), Counter(), Counter()]
    for t in train:
        s = b"\xff\xff" + low(t).encode() + b"\xff"
        for j in range(2, len(s)):
            for k in range(3):
                grams[k][s[j - k : j + 1]] += 1
    size = lambda x: math.floor(2 * math.log2(x))
    follow = [{}, {}, {}]
    for k in range(3):
        for g, c in grams[k].items():
            follow[k].setdefault(g[:-1], {})[g[-1]] = c
    rates = [{}, {}, {}]
    for k in range(3):
        for seen in follow[k].values():
            total, kinds, once = sum(seen.values()), len(seen), sum(c == 1 for c in seen.values())
            if total > 1:
                if once and kinds > 1:
                    rates[k].setdefault((size(total - 1), size(kinds - 1)), [0, 0])[0] += once
                rates[k].setdefault((size(total - 1), size(kinds)), [0, 0])[1] += total - once

    def p(context, byte, k):
        if k < 0:
            return 1 / 256
        seen = follow[k].get(context)
        if not seen:
            return p(context[1:], byte, k - 1)
        total, kinds = sum(seen.values()), len(seen)
        rate = rates[k].get((size(total), size(kinds)))
        escape = (rate[0] + 0.5) / (sum(rate) + 1) if rate else kinds / (2 * total)
        if byte in seen:
            return (1 - escape) * seen[byte] / total
        return escape * p(context[1:], byte, k - 1) / max(1e-12, 1 - sum(p(context[1:], b, k - 1) for b in seen))

    some = {i: t for i, t, _ in rows if i in (0, 1, 2, 60, 61, 63)}
    for r in got:
        if r.doc_id in some:
            s = b"\xff\xff" + low(some[r.doc_id]).encode()[:100000] + b"\xff"
            assert math.isclose(r.score, sum(math.log10(p(s[j - 2 : j], s[j], 2)) for j in range(2, len(s))), rel_tol=1e-9)


def test_near_vectors(spark):
    state = np.random.default_rng(1)
    centres = state.standard_normal((40, 16))
    x = [list(map(float, c + 0.15 * state.standard_normal(16))) for c in centres for _ in range(15)]
    x += [x[0], x[0], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, degree int")
    got = {r.vec_id: r for r in near_vectors(df, 0.9).collect()}
    ok = [i for i, v in enumerate(x) if v and len(v) == 16 and all(e is not None and math.isfinite(e) for e in v) and any(v)]
    m = np.array([np.float32(x[i]) for i in ok], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    np.fill_diagonal(near, False)
    assert len(got) == len(x)
    links = {i: int(n) for i, n in zip(ok, near.sum(1))}
    assert all(got[i].n_links <= links.get(i, 0) for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.9 * near.sum() > 0
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in got if i not in links)


def test_language(spark):
    text = {"en": "the cat and the dog sat on the mat with a thing ", "de": "der hund und die katze sind nicht in dem haus ", "fr": "le chat et le chien été dans la maison où "}
    rows = [(i, " ".join(rng.sample(words(text[lang]), 8)), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    extra = [(900, None, "en"), (901, "", "de"), (902, "123 !?", None), (903, "été", None), (904, "x" * 200_000 + " der hund und die katze", None)]
    df = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string")
    bloom = learn_filter(df, F.col("doc_id") % 3 != 7)
    got = {r.doc_id: r for r in identify(df, bloom).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "fr"]
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    none = learn_filter(df, F.lit(False))
    assert {r.lang_pred for r in identify(df, none).collect()} == {"und"}


def test_toxicity(spark):
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(VOCAB) for _ in range(40)]
        if i % 5 == 0:
            w[3], w[17], w[30] = "nasty", "vile", "nasty"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(600, None), (601, ""), (None, "nasty vile"), (5, rows[5][1])]
    labels += [(7, None), (None, 1), (999, 1), (5, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("name clash"))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    got = score_toxicity(df, lab, fit=part.isin(1, 2, 3), calibrate=part == 4).collect()
    assert len(got) == len(rows) and all(0 <= r.toxicity <= 1 for r in got)
    assert all((r.toxicity >= 0.5) == ("nasty" in (r.text or "")) for r in got)
    flat = score_toxicity(df, lab.where("toxic = 0"), fit=part.isin(1, 2, 3), calibrate=part == 4)
    assert flat.where("toxicity >= 0.5").count() == 0


def test_link_calls(spark):
    schemas = {"f": {"n": ("integer", True, 1), "s": ("string", False, 2), "list": ("array", False, None)}}
    calls = [
        ("a", None, "f", '{"s":"xy", "n": 3}'),
        ("b", "a", "f", '{"n": "3"}'),
        ("c", "b", "f", '{"n":0,"s":"x","z":1,"list":[2, 1]}'),
        ("d", "c", "g", "{}"),
        ("e", "f", "f", '{"n":1}'),
        ("f", "e", "f", '{"n":1}'),
        ("g", "gone", "f", "not json"),
        ("h", "a", "f", "[1]"),
        ("i", None, "f", '{"n":1}'),
        ("a", None, "f", '{"s":"xy", "n": 3}'),
        (None, "a", "f", "{}"),
    ]
    results = [(x, f'say "{x}"\né') for x in "abcdefgh"] + [("z", "lost"), ("a", "zzz"), (None, "x")]
    got = {
        r.call_id: r
        for r in link_calls(
            spark.createDataFrame(calls, "call_id string, parent string, name string, arguments string"),
            spark.createDataFrame(results, "call_id string, content string"),
            schemas,
        ).collect()
    }
    assert {k: (r.position, r.status, r.errors) for k, r in got.items()} == {
        "a": (0, "ok", ""),
        "b": (1, "invalid", "n: not integer"),
        "c": (2, "invalid", "n: below 1; s: below 2; z: unknown"),
        "d": (3, "invalid", "name: unknown"),
        "e": (None, "cycle", ""),
        "f": (None, "cycle", ""),
        "g": (0, "invalid", "arguments: not JSON"),
        "h": (1, "invalid", "arguments: not an object"),
        "i": (0, "unanswered", ""),
        "z": (None, "orphan", ""),
    }
    assert got["a"].json == '{"arguments":{"n":3,"s":"xy"},"id":"a","name":"f","result":"say \\"a\\"\\né"}'
    assert all(json.loads(r.json)["id"] == k for k, r in got.items())
    assert spark.range(1).select(canonical(F.lit('{"b": 1, "a": {"d":2,"c":[1, 2]}}'))).first()[0] == '{"a":{"c":[1,2],"d":2},"b":1}'


@pytest.mark.parametrize(
    "run",
    [
        lambda d, x: near_copies(d, 3, 90),
        lambda d, x: remove_repeats(d),
        lambda d, x: find_leaks(d, d.select(F.col("doc_id").alias("item_id"), "text")),
        lambda d, x: mix(d),
        lambda d, x: reshard(d, F.lit(1), F.xxhash64("text"), F.lit(0)),
        lambda d, x: score_texts(d, F.col("doc_id") == 1),
        lambda d, x: identify(d, learn_filter(d.withColumn("lang", F.lit("en")), F.lit(True))),
        lambda d, x: score_toxicity(d, d.select("doc_id", F.lit(1).alias("toxic")), F.lit(True), F.lit(False)),
        lambda d, x: near_vectors(x, 0.9),
    ],
)
def test_empty_tables(spark, run):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert run(docs, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_kept_text_digest(docs):
    kept = remove_repeats(docs).select("kept", F.sha2("kept", 256).alias("digest")).collect()
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.digest for r in kept)


def test_blocks_of_a_mixed_group_cover_all_pairs():
    rng = np.random.default_rng(5)
    n, blocks = 60, 3
    doc, block = np.arange(n), rng.integers(0, blocks, n)
    component = np.where(rng.random(n) < 0.6, 0, rng.integers(0, 12, n))
    marks = [bytes(x) for x in rng.integers(0, 256, (n, 8), dtype=np.uint8)]
    found = []
    for low in range(blocks):
        for high in range(low, blocks):
            at = np.flatnonzero((block == low) | (block == high))
            table = pa.table(
                {
                    "grp": np.full(len(at), 7), "low": np.full(len(at), low), "high": np.full(len(at), high), "block": block[at],
                    "doc": doc[at], "component": component[at], "n": np.full(len(at), 20), "marks": [marks[i] for i in at],
                }
            )
            pairs = _comparing(1, None)(table).to_pydict()
            assert not any(pairs["cut"])
            found += [*zip(pairs["a"], pairs["b"])]
            few = _comparing(1, 1)(table).to_pydict()
            assert set(zip(few["a"], few["b"])) <= set(zip(pairs["a"], pairs["b"]))
            assert all(few["cut"]) or set(zip(few["a"], few["b"])) == set(zip(pairs["a"], pairs["b"]))
    wanted = {(a, b) for a in range(n) for b in range(a + 1, n) if component[a] != component[b]}
    assert len(found) == len(set(found)) and set(found) == wanted


def test_members_meet_in_the_first_group_they_share():
    """Members of several groups, each carrying its first groups only: a pair that shares groups is found, mostly in one."""
    rng = np.random.default_rng(3)
    n, groups = 40, np.sort(rng.integers(-(2**62), 2**62, 60))
    of = [np.sort(rng.choice(groups, rng.integers(1, 40), replace=False)) for _ in range(n)]
    component = rng.integers(0, 6, n)
    marks = np.zeros(8, np.uint8).tobytes()
    found = Counter()
    for g in groups:
        inside = np.array([i for i in range(n) if g in of[i]], dtype=np.int64)
        if len(inside) < 2:
            continue
        table = pa.table(
            {
                "grp": np.full(len(inside), g), "low": np.zeros(len(inside), np.int64), "high": np.zeros(len(inside), np.int64),
                "block": np.zeros(len(inside), np.int64), "doc": inside, "component": component[inside], "n": np.full(len(inside), 20),
                "marks": [marks] * len(inside), "groups": pa.array([of[i][:16].tolist() for i in inside], pa.list_(pa.int64())),
            }
        )
        pairs = _comparing(1, None)(table).to_pydict()
        found.update(zip(pairs["a"], pairs["b"]))
    wanted = {(a, b) for a in range(n) for b in range(a + 1, n) if component[a] != component[b] and set(of[a]) & set(of[b])}
    assert set(found) == wanted and found.total() < 2 * len(wanted)
