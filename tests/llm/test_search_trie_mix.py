"""Ranked search, prefix trie and source mix against brute force, and their odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from doorledger.llm import lexical_search, prefix_trie, source_mix
from doorledger.llm.catalog import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    bags = [(d, terms_of(t)) for d, t in docs]
    bags = [(d, Counter(t), len(t)) for d, t in bags if t]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, n in bags:
            m = 75 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms_of(text))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows)[:k])]
    return out


def test_search_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["Ab", "ab", "c1", "é", "ÉÀ", "日本", "x", "the", "zq", "w9", "long", "tail"]
    docs = [(i, rnd.choice([" ", "-", "\x00", "\t. "]).join(rnd.choices(words, k=rnd.randrange(1, 30)))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(40)]  # a class of many members
    docs += [(None, docs[3][1]), (3, docs[3][1]), (400, None), (401, ""), (402, "!?"), (403, "the " * 70_000)]
    items = [(0, "AB c1 ab é the"), (1, docs[3][1]), (2, None), (3, "?"), (4, "nowhere"), (1, "x X x"), (None, "日本 tail")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute_search(docs, items, 20), key=str)
    # small slices cut texts, small steps cut classes, small blocks cut items
    monkeypatch.setattr(lexical_search, "_AT_ONCE", 50)
    for block in (1 << 20, 4):
        got = [tuple(r) for r in lexical_search.ranked(d, i, block=block).collect()]
        assert sorted(got, key=str) == want
    assert lexical_search.ranked(d.where("false"), i).count() == 0
    assert lexical_search.ranked(d, i.where("false")).count() == 0


def test_slices_cut_no_term(monkeypatch):
    monkeypatch.setattr(lexical_search, "_SLICE", 7)
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choices("ab é日 -.", k=rnd.randrange(0, 60)))
        got = [t.decode() for part in lexical_search.term_runs(text.encode()) for t in part]
        assert got == terms_of(text)


def test_counts_survive_packing():
    found = Counter({5: 3, 1: 70_000, 9: 1})
    ids, tf = lexical_search.unpack(lexical_search.pack(found))
    assert dict(zip(ids.tolist(), tf.tolist(), strict=True)) == dict(found)
    assert lexical_search.pack(Counter()) == b""


def brute_trie(rows, block):
    """Rows (conv, turn, role, text) to the set of nodes, with sets of members."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if block else 0
        built[c] = own.get(c - math.fmod(c, block), [])[:h] + ts[h:] if block else ts
    member, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            member[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = Counter(p[:-1] for p in member if p)
    leaves, saved = Counter(), Counter()
    for p, cs in member.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(cs), len(p), min(member[p[:-1]]) if p else -1, len(cs), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, cs in member.items())


def conversations(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, 260), 500, 777, 1200]:
        if c == 100:
            continue  # a block without its first conversation
        for t in range(rnd.choice([1, 2, 3, 8])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "", "Ünï 😀", None, f"own {c}"])))
    rows += [(300, t, "user", f"step {t}") for t in range(400)]  # a long one
    rows += [(c, t, "user", "same") for c in range(310, 380) for t in (1, None, 3)]  # many equal ones
    return rows + [(None, 0, "user", "nobody's")]


@pytest.mark.parametrize("least,top", [(1, 1 << 19), (4, 1 << 19), (1000, 1 << 19), (1, 40)])
@pytest.mark.parametrize("block", [None, 100])
def test_trie_equals_brute_force(spark, monkeypatch, least, top, block):
    monkeypatch.setattr(prefix_trie, "_ROWS", 50)
    monkeypatch.setattr(prefix_trie, "TOP_NODES", top)
    rows = conversations(least)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(9)).repartition(3)
    got = prefix_trie.nodes(df, block, least=least).fillna(-1, ["parent_conv_id"]).collect()
    assert sorted(tuple(r) for r in got) == brute_trie(rows, block)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.nodes(df, 100).count() == 0


def test_slot_table():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), "<u8").reshape(-1, 4)
    table = prefix_trie.SlotTable(keys[:4000])
    assert sorted(table.slots(keys[:4000]).tolist()) == list(range(4000))
    assert (table.slots(keys[4000:]) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(keys[[1, 1]])


def test_targets():
    got = source_mix.targets({"b": 10, "a": 1000, None: 90, "c": 0})
    # a 1, b 2, c 3, null 1 of 1100 words; b, c and null stop at three times their size
    assert got == {"c": 0.0, "b": 30.0, None: 270.0, "a": 800.0}
    assert sum(got.values()) == 1100


def brute_flow(patterns, quotas, most):
    """Cheapest largest flow by one word at a time over shortest paths (small cases)."""
    flow = source_mix._Flow(2 + len(patterns) + len(quotas))
    s_at = {s: 2 + len(patterns) + i for i, s in enumerate(quotas)}
    for i, (p, words) in enumerate(patterns.items()):
        for r in range(most):
            for _ in range(words):
                flow.arc(0, 2 + i, 1, r * r)
        for s in p:
            flow.arc(2 + i, s_at[s], 10**6, 0)
    for s, q in quotas.items():
        flow.arc(s_at[s], 1, round(q), 0)
    total = cost = 0
    while True:  # Bellman-Ford, one word a time
        far, by = [math.inf] * len(flow.out), {}
        far[0] = 0
        for _ in flow.out:
            for a, arcs in enumerate(flow.out):
                for e in arcs:
                    if flow.room[e] and far[a] + flow.cost[e] < far[flow.head[e]]:
                        far[flow.head[e]], by[flow.head[e]] = far[a] + flow.cost[e], e
        if far[1] == math.inf:
            return total, cost
        at, total, cost = 1, total + 1, cost + far[1]
        while at:
            flow.room[by[at]] -= 1
            flow.room[by[at] ^ 1] += 1
            at = flow.head[by[at] ^ 1]


@pytest.mark.parametrize("seed", range(8))
def test_flow_is_cheapest(seed):
    rnd = random.Random(seed)
    names = ["a", "b", "c", None]
    patterns = {}
    for _ in range(rnd.randrange(1, 6)):
        p = tuple(sorted(rnd.sample(names, rnd.randrange(1, 4)), key=str))
        patterns[p] = rnd.randrange(0, 7)
    quotas = {s: float(rnd.randrange(0, 15)) for p in patterns for s in p}
    got = source_mix.routed(patterns, quotas)
    into = Counter()
    cost = 0
    for p, by_source in got.items():
        f = sum(by_source.values())
        assert f <= 3 * patterns[p] and by_source.keys() <= set(p)
        into.update(by_source)
        cost += sum(r * r * min(max(f - r * patterns[p], 0), patterns[p]) for r in range(3))
    assert all(into[s] <= quotas[s] for s in quotas)
    assert (sum(into.values()), cost) == brute_flow(patterns, quotas, 3)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(docs, rows):
    """docs: (id, source, text) with unique ids; rows of the registered query's shape."""
    size = {d: words(t) for d, _, t in docs}
    by_source = Counter()
    for d, s, _ in docs:
        by_source[s] += size[d]
    wanted = source_mix.targets(dict(by_source))
    taken = Counter()
    source = {d: s for d, s, _ in docs}
    assert sorted(r.doc_id for r in rows) == sorted(size)
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], by_source[s])
        assert r.target == pytest.approx(wanted[s], abs=1e-6)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    return {s: (taken[s], wanted[s]) for s in by_source}


def test_mix_meets_its_targets(spark, tmp_path):
    rnd = random.Random(8)
    docs = [(i, rnd.choice(["hot"] * 6 + ["b", "é", "", None]), rnd.choice([" ", "\n\t", "\xa0"]).join("w" * rnd.randrange(1, 300))) for i in range(3000)]
    docs += [(5000, "hot", "w " * 90_000), (5001, "tiny", "one two three"), (5002, "empty", None), (5003, "empty", ""), (5004, "b", " \t")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(d, t, s, 1) for d, s, t in docs], "doc_id long, text string, source string, size int").repartition(4).write.parquet(path)
    first = QUERIES["op13_source_mix"][0](spark, str(tmp_path)).collect()
    for got, want in check_mix(docs, first).values():
        assert abs(got - want) <= max(3, 0.002 * want)
    again = QUERIES["op13_source_mix"][0](spark, str(tmp_path)).collect()
    assert sorted(first) == sorted(again)


def test_mix_of_overlapping_sources(spark):
    rows = [(i, ["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else ["b", "c", "c"], "w " * (1 + i % 50)) for i in range(1500)]
    rows += [(9000, [], "not drawn"), (9001, None, "nor this")]
    df = spark.createDataFrame(rows, "doc_id long, s array<string>, text string")
    got = source_mix.mixed(df, F.col("s")).collect()
    assert len(got) == len(rows)
    assert {r.id: r.taken for r in got if r.id >= 9000} == {9000: 0, 9001: 0}
    drawn = sum(r.taken for r in got)
    total = sum(r.size for r in got if r.id < 9000)
    assert abs(drawn - total) < 0.002 * total  # all quotas together are all words, and the flow can meet them
    assert source_mix.mixed(df.where("false"), F.col("s")).count() == 0


def test_registered_shapes(spark):
    sf = "/root/testdata/sf0.001"
    shapes = {name: QUERIES[name][0](spark, sf).dtypes for name in ("op11_bag_dedup_search", "op12_prefix_trie", "op13_source_mix")}
    assert shapes["op11_bag_dedup_search"] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert shapes["op12_prefix_trie"] == [(c, "bigint") for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", "string")]
    assert shapes["op13_source_mix"] == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
