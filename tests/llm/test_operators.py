"""The corpus operators against brute force and round trips on small tables."""

import hashlib
import zlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
from doorledger.llm import bpe, chat, common, exact_dedup, language, near_dedup, packing, suffix_dedup, toxicity, url_filter, vector_dedup  # noqa: E402
from doorledger.llm.catalog import tokenizer_file  # noqa: E402
from doorledger.llm.common import connected_components  # noqa: E402

PATH = tokenizer_file()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (60, 51), (7, 7)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 50: 50, 51: 50, 60: 50}
    assert connected_components(edges.where("false")).count() == 0


def test_components_in_one_step_or_many(spark, monkeypatch):
    """Few edges need no round of shuffles, however long the chain; many edges give the same by rounds."""
    n = 3000
    rows = [(i, i + 1) for i in range(n)] + [(i + 10_000, i + 10_001) for i in range(0, n, 2)] + [(None, 1), (2, None), (9, 9)]
    edges = spark.createDataFrame(rows, "src long, dst long").repartition(7).localCheckpoint()
    want = {**dict.fromkeys(range(n + 1), 0), **{i + 10_000 + k: i + 10_000 for i in range(0, n, 2) for k in (0, 1)}}
    kept, written = common.stored, []
    monkeypatch.setattr(common, "stored", lambda df, *a: written.append(1) or kept(df, *a))
    assert {r.node: r.component for r in connected_components(edges).collect()} == want
    assert len(written) <= 2
    monkeypatch.setattr(common, "AT_ONCE", 100)
    assert {r.node: r.component for r in connected_components(edges).collect()} == want
    assert len(written) > 4


def test_suffix_arrays_stay_small():
    """What a worker keeps, and the largest arrays over a run of short texts."""
    import tracemalloc

    rng = np.random.default_rng(0)
    texts = pa.array([rng.integers(32, 127, 2000, dtype=np.uint8).tobytes() for _ in range(2000)], pa.binary())
    suffix_dedup._tables.clear()
    tracemalloc.start()
    n = sum(len(x["h"]) for x in suffix_dedup._occurrences(iter([{"_text": texts, common.RID: pa.array(range(2000), pa.int64())}])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 10_000 and sum(x.nbytes for t in suffix_dedup._tables.values() for x in t) < 20 << 20
    assert peak < 80 << 20, peak >> 20


def test_bpe_equals_library(odd_docs, no_docs):
    library = tokenizers.Tokenizer.from_file(PATH)
    got = Counter(tuple(r) for r in bpe.round_trip_digests(odd_docs, PATH).collect())
    want = Counter()
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert got == want
    assert bpe.round_trip_digests(no_docs, PATH).count() == 0


@pytest.mark.parametrize("text", ["abcdefghij" * 900, "theing" * 1500, "é中a" * 3000, "!-." * 3000, "'re" * 9000])
def test_long_words_stream_through_a_window(text):
    encoder = bpe.encoder_of(PATH)
    ids = np.frombuffer(b"".join(encoder.blocks(text)), "<u4").tolist()
    assert ids == tokenizers.Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_new_words_of_many_texts_are_merged_together(monkeypatch):
    """A word that no task has met before costs no Python of its own."""
    def alone(*_):
        raise AssertionError("a simple word was merged alone")

    rng = np.random.default_rng(3)
    letters = np.array([*"aeinorstéß"])
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 30))).capitalize() + rng.choice(["", ".", "!!", "42"]) for _ in range(40)) for _ in range(60)]
    library, encoder = tokenizers.Tokenizer.from_file(PATH), bpe.Encoder(bpe.Vocabulary(PATH))
    monkeypatch.setattr(bpe.Vocabulary, "merged", alone)
    got = [np.frombuffer(b"".join(blocks), "<u4").tolist() for blocks in encoder.texts(pa.array(texts))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("ahead, block", [(1 << 22, 1 << 20), (60, 16)])
def test_columns_of_texts_equal_library(monkeypatch, ahead, block):
    """Kinds of characters side by side, nulls, slices, and texts longer than what is encoded at a time."""
    monkeypatch.setattr(bpe, "AHEAD", ahead)
    monkeypatch.setattr(bpe, "BLOCK", block)
    parts = ["a", "The", "É", "İ", "Ⱥ", "ß", "'", "'s", "'LL", "12", "²", "½", "!?", "|", "<|startoftext|>", "<|", " ", "\n", "\x1c", "\x85", "\xa0", "\u3000",
             "\u200a", "中", "e\u0301", "😀", "’", "\xad", "\x00", "ǅ", "Σ", "x" * 30, "!" * 60, "-"]
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(800)] + [f"{a}{b} {a}1{b}a" for a in parts for b in parts] + ["", None, None]
    library, encoder = tokenizers.Tokenizer.from_file(PATH), bpe.encoder_of(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for column in (pa.array(texts), pa.array(["cut off", *texts, "é"], pa.large_string()).slice(1, len(texts))):
        assert [np.frombuffer(b"".join(blocks), "<u4").tolist() for blocks in encoder.texts(column)] == want
    assert list(encoder.texts(pa.array([], pa.string()))) == []


def test_decoder_keeps_split_characters():
    text = "aé中😀b"
    d = bpe.Decoder([bytes([i]) for i in range(256)], b"")
    parts = [d.feed([b]) for b in text.encode()] + [d.close()]
    assert "".join(parts) == text and max(map(len, parts)) == 1


def test_url_rules_and_aliases(spark):
    link = '<link href="{}" rel="canonical">'
    rows = [(1, "http://a.example.com/en/x", None), (2, "https://WWW.example.com/en/", ""), (3, "http://b.net/es/1", "x"),
            (4, "http://alias.org/p", link.format("http://b.net/es/1")), (5, "http://far.org/", '<meta http-equiv="refresh" content="0; url=http://alias.org/p">'),
            (6, "http://www.example.com/en/q", link.format("http://b.net/es/1")), (7, None, None), (8, "nothing", None), (9, "http://com/", None), (9, "http://com", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, component int")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(df, url_filter.RULES).orderBy("page_id", "path").collect()]
    assert got == [(1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
                   (3, "b.net", "/es/1", "net/es/", "block"), (4, "alias.org", "/p", None, "block"), (5, "far.org", "/", None, "block"),
                   (6, "www.example.com", "/en/q", "www.example.com/en/", "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"),
                   (9, "com", "", None, "allow"), (9, "com", "/", "com/", "allow")]


def test_near_groups(odd_docs, no_docs):
    got = defaultdict(set)
    rows = near_dedup.near_groups(odd_docs).collect()
    for r in rows:
        got[r.component_id].add(r.id)
    assert len(rows) == odd_docs.count() and got[1] == {1, 2, 3} and got[7] == {7, None} and got[4] == {4} and got[5] == {5}
    assert sum(r.kept for r in rows) == len({r.component_id for r in rows})
    assert near_dedup.near_groups(no_docs).count() == 0
    assert near_dedup.drop_near_copies(odd_docs).columns == odd_docs.columns


def test_similar_equals_pairwise():
    rng, vec = np.random.default_rng(1), []
    for _ in range(60):
        h = np.sort(rng.choice(np.arange(1, 40, dtype=np.uint64), rng.integers(5, 30), replace=False))
        vec.append((h, 1.5 * rng.integers(1, 3, len(h))))
    every = np.arange(60)
    want = [[(x := near_dedup.shared_weight(*p, *q)) >= 0.8 * (p[1].sum() + q[1].sum() - x) - 1e-9 for q in vec] for p in vec]
    assert (near_dedup.similar(vec, every, every, 7) == np.array(want)).all()


def test_exact_groups(odd_docs, no_docs):
    groups = defaultdict(list)
    for r in odd_docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    want = Counter((i, min((x for x in ids if x is not None), default=None), len(ids), sha(t)) for t, ids in groups.items() for i in ids)
    for budget in (1 << 30, 100):  # the second spills after every batch
        rows = exact_dedup.exact_groups(odd_docs, trie_bytes=budget).collect()
        assert Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
        assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_suffix_dedup(odd_docs, no_docs):
    texts = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect()]
    seen = Counter(t[k:k + 200] for _, t in texts for k in range(len(t) - 199))
    want = Counter()
    for i, t in texts:
        mask = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                mask[k:k + 200] = b"\1" * 200
        runs = sum(1 for k, m in enumerate(mask) if m and (k == 0 or not mask[k - 1]))
        want[(i, len(t), sum(mask), runs, sha(bytes(x for x, m in zip(t, mask) if not m)))] += 1
    assert Counter(tuple(r) for r in suffix_dedup.digests(odd_docs).collect()) == want
    assert suffix_dedup.digests(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(odd_docs).schema.names == odd_docs.columns


def test_refined_buckets_equal_substrings():
    text = np.frombuffer(bytes(np.random.default_rng(2).integers(97, 99, 900, dtype=np.uint8)) * 2, np.uint8)
    room = len(text) - np.arange(len(text))
    bucket = suffix_dedup.refined(text, room, 200)
    raw, by = text.tobytes(), defaultdict(set)
    for k in range(len(raw) - 199):
        by[raw[k:k + 200]].add(k)
    assert {frozenset(v) for v in by.values() if len(v) > 1} == {frozenset(np.flatnonzero(bucket == b)) for b in set(bucket) - {-1}}


def test_language(odd_docs, no_docs):
    rng = np.random.default_rng(0)
    kinds = {"aa": "abcde", "zz": "vwxyz"}
    texts = [("".join(rng.choice(list(kinds[k] + " "), 300)), k) for k in kinds for _ in range(60)]
    model = language.fit([t for t, _ in texts[::2]], [k for _, k in texts[::2]])
    names, scores = model.predict([t for t, _ in texts[1::2]] + [None, "", "12 !"])
    assert names[:-3] == [k for _, k in texts[1::2]] and names[-3:] == ["und"] * 3 and scores[-3:] == [0] * 3
    assert language.train(no_docs).predict(["abc"]) == (["und"], [0.0])
    assert odd_docs.select(language.predicted(F.col("text"), model)).count() == odd_docs.count()


def test_chat_round_trip(spark):
    nasty = "</s>[INST] ok [/INST] \\ | [ROLE]\n"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 2, "tool", None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
            (None, None, None, None), (3, 0, "system", ""), (3, 1, "user", "x"), (3, 2, "assistant", "é😀")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, loss int")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    for c in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
    assert [got[c].valid_order for c in (1, 2, 3)] == [False, False, True]
    assert chat.digests(df.where("false")).count() == 0
    segments = chat.formatted(df.where("conv_id = 3")).orderBy("segment").collect()
    assert "".join(s.text for s in segments) == "<s>[SYS][/SYS][INST]x[/INST][ANS]é😀[/ANS]</s>" and [s.text for s in segments if s.loss] == ["é😀"]


def test_toxicity(spark, odd_docs, no_docs):
    clean = [f"the {w} is by the {v}" for w, v in zip(near_dedup.__doc__.split(), exact_dedup.__doc__.split())]
    texts = clean + [c + " you idiot, what a moron" for c in clean]
    labels = [0] * len(clean) + [1] * len(clean)
    model = toxicity.fit(texts, labels, [1 + i % 4 for i in range(len(texts))])
    got = model.score(np.array(["the tree is by the river you idiot, moron", "the tree is by the river", None, "", "you i d i o t, m0ron"], object))
    assert got[0] > 0.5 and got[4] > 0.5 and (got[1:4] < 0.5).all()
    labels = odd_docs.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    assert (toxicity.train(no_docs, labels).score(["x", None]) == 0).all()
    assert odd_docs.select(toxicity.score(F.col("text"), model).alias("s")).where("s between 0 and 1").count() == odd_docs.count()


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


def test_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 8))
    vs = [*base, *(base[:20] + rng.normal(scale=0.15, size=(20, 8))), base[0], base[0] * 2]
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vs)]
    rows += [(100, None, 1), (101, [0.0] * 8, 1), (102, [float("nan")] * 8, 1), (103, [None] * 8, 1), (104, rows[0][1], None), (105, [1.0, 2.0], 0), (0, rows[0][1], 0)]
    path = str(tmp_path / "v")
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, component int").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    links, root = defaultdict(set), {i: i for i in range(len(rows))}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a[2] is not None and a[2] == b[2] and a[1] and b[1] and len(a[1]) == len(b[1]) and None not in a[1] + b[1]:
                x, y = np.array(a[1]), np.array(b[1])
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any() and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links[i].add(j)
    for _ in rows:
        for i in links:
            for j in links[i]:
                root[i] = root[j] = min(root[i], root[j], key=lambda k: (rows[k][0], k))
    want = Counter((r[0], len(links[i]), rows[root[i]][0]) for i, r in enumerate(rows))
    cell, vector_dedup.CELL = vector_dedup.CELL, 5
    try:
        assert Counter((r.id, r.n_links, r.component_id) for r in vector_dedup.vector_groups(df).collect()) == want
    finally:
        vector_dedup.CELL = cell
    assert Counter((r.id, r.n_links, r.component_id) for r in vector_dedup.vector_groups(df).collect()) == want
    assert vector_dedup.vector_groups(df.where("false")).count() == 0


def test_packing(odd_docs, no_docs):
    library = tokenizers.Tokenizer.from_file(PATH)
    rows = packing.packed(odd_docs, PATH, capacity=64).collect()
    want = Counter()
    for r in odd_docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.update((r.doc_id, k // 64, k, len(ids[k:k + 64]), zlib.crc32(np.array(ids[k:k + 64], "<u4").tobytes()))
                    for k in range(0, len(ids), 64))
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for spans in filled.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 64
    assert len(filled) <= -(-sum(r.length for r in rows) // 64) + 1
    assert packing.packed(no_docs, PATH).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plan_holds_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, 257, 120)}
    held = Counter()
    for n, items in packing.plan(histogram, 256, groups=8):
        assert sum(a * k for a, k in items) <= 256
        for a, k in items:
            held[a] += n * k
    assert held == histogram


@pytest.mark.parametrize("seed,n", [(0, 1000), (1, 1000), (2, 10_000), (3, 200_000)])
def test_plan_comes_near_the_bound(seed, n):
    """Lengths as of the given documents: many short, some long ones cut into whole sequences and a rest."""
    rng = np.random.default_rng(seed)
    lengths = np.exp(rng.normal(6.4, 1.0, n)).astype(int) + 1
    histogram = Counter(np.concatenate([lengths % 4096 + 1, np.full(int((lengths // 4096).sum()), 4096)]).tolist())
    runs = packing.plan(dict(histogram))
    held = Counter()
    for times, items in runs:
        for length, copies in items:
            held[length] += times * copies
    assert held == histogram
    bound = -(-sum(k * v for k, v in histogram.items()) // 4096)
    assert sum(times for times, _ in runs) <= bound * 1.002 + 0.5


def test_pipeline_on_a_small_table(spark, tmp_path):
    import corpus_pipeline
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 100 and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]


def test_row_numbers_hold_when_the_input_is_split_anew(spark, tmp_path, monkeypatch):
    """Each stored stage is followed by another split of the scans, as when executors come and go."""
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words[k * 40:k * 40 + 100]) for k in range(30)]
    rows = [(i, texts[i % 30] if i < 60 else texts[i % 30].replace(f"w{i % 30 * 40 + 50} ", "other "), [float(i % 30 == j) for j in range(30)], 0)
            for i in range(90)]
    path = str(tmp_path / "docs")
    for part in range(3):  # files of different sizes, with several row groups each
        some = spark.createDataFrame([r for r in rows if (r[0] // 7) % 3 == part], "doc_id long, text string, embedding array<double>, label int")
        some.coalesce(1).write.mode("append").option("parquet.block.size", 2048).option("parquet.page.size.row.check.min", 2).option("parquet.block.size.row.check.min", 2).parquet(path)
    docs, n, cost = spark.read.parquet(path), [0], "spark.sql.files.openCostInBytes"

    def splitting(df, *args, keep=common.stored):
        out = keep(df, *args)
        n[0] += 1
        spark.conf.set(cost, ["0", "4194304"][n[0] % 2])
        spark.conf.set("spark.sql.files.maxPartitionBytes", ["3000", "134217728"][n[0] % 2])
        return out

    def run():
        exact = Counter(r.text for r in exact_dedup.drop_copies(docs).collect())
        kept = Counter(r.doc_id for r in near_dedup.drop_near_copies(docs).collect())
        cut = Counter((r.id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.digests(docs).collect())
        links = Counter((r.id, r.n_links, r.component_id) for r in vector_dedup.vector_groups(docs, "doc_id").collect())
        return exact, kept, cut, links

    want = run()
    assert want[0] == Counter({t: 1 for t in {r[1] for r in rows}}) and want[3] == Counter((i, 2, i % 30) for i in range(90))
    try:
        for module in (common, near_dedup, exact_dedup, suffix_dedup, vector_dedup):
            monkeypatch.setattr(module, "stored", splitting)
        assert run() == want
    finally:
        for key in (cost, "spark.sql.files.maxPartitionBytes"):
            spark.conf.unset(key)


def test_path_follows_the_first_scheme_only(spark):
    urls = {"https://shop.net?next=http://x.net/fr/a": "", "https://a.com?u=http://b/c": "", "http://a.com#http://b/c": "", "http://h/a/://b/c?d": "/a/://b/c",
            "http://h": "", "http://h/": "/", "http://h/p\nq?x#y": "/p\nq", "x://é/é/😀?a/b": "/é/😀", "no/scheme": "", "": "", "a?b=c://d/e": "/e", "http://h" + "/a" * 50_000: "/a" * 50_000}
    df = spark.createDataFrame([(u, None) for u in [*urls, None]], "url string, html string")
    got = {r.url: (r.path, r.rule) for r in url_filter.judged(df, url_filter.RULES).collect()}
    assert {u: p for u, (p, _) in got.items()} == {**urls, None: ""}
    assert got["https://shop.net?next=http://x.net/fr/a"][1] is None and got["https://a.com?u=http://b/c"][1] is None


@pytest.mark.parametrize("target, want", [
    ("//o.net/p", "http://o.net/p"), ("/r?x", "http://h.org/r?x"), ("page.html", "http://h.org/a/b/page.html"), ("../x", "http://h.org/a/x"),
    ("../../../x", "http://h.org/x"), ("./", "http://h.org/a/b/"), ("..", "http://h.org/a/"), ("?id=1", "http://h.org/a/b/c?id=1"),
    ("#f", "http://h.org/a/b/c?q=/z#f"), ("go?u=http://x.net/", "http://h.org/a/b/go?u=http://x.net/"), ("https://o.net/../p", "https://o.net/../p"),
    ("mailto:a@b", None), ("/x/../y/./z", "http://h.org/y/z")])
def test_resolved_links(target, want):
    assert url_filter.resolved("http://h.org/a/b/c?q=/z#w", target) == want
    assert url_filter.resolved("http://h.org", "x") == "http://h.org/x" and url_filter.resolved("no scheme", target) in (None, target)


def test_all_aliases_of_a_page(spark):
    def link(t):
        return f'<LINK rel="canonical" href="{t}">'

    def refresh(t):
        return f'<meta http-equiv=refresh content="0; url={t}">'

    blocked = "http://b.net/es/1?a=1&b=2"
    pages = [(1, "http://b.net/x/1", link("../es/1?a=1&amp;b=2")), (2, "http://o.org/", link("//b.net/es/1?a=1&#38;b=2")), (3, "http://b.net/es/1?a=1&b=2", None),
             (4, "http://two.org/", link("http://two.org/else") + link(blocked)), (5, "http://three.org/", refresh("/x") + "<p>" + refresh(blocked)),
             (6, "http://b.net/p/q", link("?id=1")), (7, "http://b.net/p/q?id=1", refresh("//b.net/es/2")), (8, "http://free.org/", link("other.html") + refresh("?&copy=1")),
             (9, "http://free.org/other.html", None), (10, "http://free.org/?&copy=1", link("mailto:x@b.net/es/"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judged(df, url_filter.RULES).collect()}
    assert got == {**dict.fromkeys(range(1, 8), "block"), **dict.fromkeys((8, 9, 10), "allow")}
    assert {(r.url, r.target) for r in url_filter.links(df.where("page_id = 8"), "url", "html").collect()} == {
        ("http://free.org/", "http://free.org/other.html"), ("http://free.org/", "http://free.org/?&copy=1")}


def test_hot_anchors_are_split(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)

    def noise(n):
        return bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()

    short, long = noise(120), noise(230)
    texts = [noise(150) + (short if i % 3 else long) + noise(150) for i in range(90)] + [noise(10) + short + short + noise(90)]
    texts += [texts[4], texts[4], short, long, short * 4, noise(100) + texts[6] + noise(100)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(path)
    raw = [t.encode() for t in texts]
    seen, want = Counter(t[k:k + 200] for t in raw for k in range(len(t) - 199)), set()
    for i, t in enumerate(raw):
        mask = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                mask[k:k + 200] = b"\1" * 200
        want.add((i, sum(mask), sha(bytes(x for x, m in zip(t, mask) if not m))))

    def bounded(batches, edges=suffix_dedup._edges):
        def counted(n=Counter()):
            for b in batches:
                n.update(b["h"].to_pylist())
                assert max(n.values()) <= 20, "a hot anchor lies in one task"
                yield b
        return edges(counted())

    monkeypatch.setattr(suffix_dedup, "HOT", 20, raising=False)
    monkeypatch.setattr(suffix_dedup, "_edges", bounded)
    got = {(r.id, r.n_removed, r.kept_sha256) for r in suffix_dedup.digests(spark.read.parquet(path)).collect()}
    assert got == want and sum(w[1] > 0 for w in want) > 30


def test_suffix_dedup_of_a_very_long_text(spark, tmp_path):
    """Over 8 MB, so that it is read in slices; the passage lies in three of them and in another text."""
    rng = np.random.default_rng(6)

    def noise(n):
        return bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()

    passage = noise(500)
    long = noise(1_000) + "A" + passage + "B" + noise(5_000_000) + "C" + passage + "D" + noise(4_200_000) + "E" + passage + "F" + noise(300)
    texts = [long, noise(100) + "G" + passage + "H" + noise(100), noise(3000)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    got = {r.id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(spark.read.parquet(path)).collect()}
    assert got == {0: (1500, 3, sha(long.replace(passage, ""))), 1: (500, 1, sha(texts[1].replace(passage, ""))), 2: (0, 0, sha(texts[2]))}


@pytest.mark.parametrize("seed", range(20))
def test_refined_regions_equal_substrings(seed):
    """Regions of copied blocks; no string runs over the end of its region."""
    rng = np.random.default_rng(seed)
    blocks = [bytes(rng.integers(97, 123, rng.integers(1, 260), dtype=np.uint8)) for _ in range(3)]
    regions = [(b"".join(blocks[i] for i in rng.integers(0, 3, 3)) + bytes(rng.integers(97, 123, 50, dtype=np.uint8)))[:rng.integers(200, 400)]
               for _ in range(12)]
    room = np.concatenate([np.arange(len(r), 0, -1) for r in regions])
    raw = b"".join(regions)
    bucket = suffix_dedup.refined(np.frombuffer(raw, np.uint8), room)
    by, got = defaultdict(set), defaultdict(set)
    for p in np.flatnonzero(room >= 200).tolist():
        by[raw[p:p + 200]].add(p)
    for p in np.flatnonzero(bucket >= 0).tolist():
        got[bucket[p]].add(p)
    assert {frozenset(v) for v in by.values() if len(v) > 1} == {frozenset(v) for v in got.values()}


def test_verdicts_equal_a_closure_over_links(spark):
    """Generated pages with links of every form against a plain closure, and against the query's SQL where that states them."""
    import duckdb
    from doorledger.llm.catalog import SQL2

    rng = np.random.default_rng(11)
    urls = [f"http://{h}/{p}/{i}" for i in range(12) for h, p in (("a.net", "es"), ("b.org", "en"), ("c.net", "xx"), ("x.com", "en"))]

    def pages_of(forms):
        out = []
        for k, u in enumerate(urls):
            tags = []
            for _ in range(rng.integers(0, 3)):
                t = forms[rng.integers(len(forms))](urls[rng.integers(len(urls))])
                tags.append(f'<link rel="canonical" href="{t}">' if rng.random() < 0.5 else f"<meta http-equiv='refresh' content='0;url={t}'>")
            if rng.random() < 0.4:
                out.append((k, u, "<p>".join(tags) or None, "h", 1))
        return [*out, (97, None, "<p>", "h", 1), (98, "none", "", "h", 1), (98, "none", "", "h", 1)]

    plain = [lambda u: u, lambda u: u[5:], lambda u: u[u.index("/", 7):], lambda u: u + "?a=1&amp;b=2"]
    odd = [*plain, lambda u: "../en/" + u[-1], lambda u: "?q=" + u[-1], lambda u: u[-1]]
    for forms in (plain, odd):
        pages = pages_of(forms)
        df = spark.createDataFrame(pages, "page_id long, url string, html string, host string, _node int")
        got = url_filter.judged(df, url_filter.RULES)
        assert set(got.columns) == {"page_id", "url", "html", "host", "_node", "path", "rule", "verdict"}
        near = defaultdict(set)
        for _, u, html, *_ in pages:
            for t in re.findall(r"""(?:href="|;url=)([^"']+)""", html or ""):
                t = url_filter.resolved(u, t.replace("&amp;", "&"))
                near[u].add(t)
                near[t].add(u)

        def own(u):
            host, _, path = u.split("://", 1)[1].partition("/") if "://" in u else ("", "", "")
            path = ("/" + path).split("?")[0]
            return ("block" if host.endswith(".net") and path.startswith(("/es/", "/fr/")) else "allow" if host.endswith(".com") else None)

        want = Counter()
        for k, u, *_ in pages:
            seen, todo = {u}, [u] if u else []
            while todo:
                new = near[todo.pop()] - seen
                seen |= new
                todo += new
            want[k, (own(u or "") or ("block" if any(own(v) == "block" for v in seen if v) else "allow"))] += 1
        assert Counter((r.page_id, r.verdict) for r in got.collect()) == want and len({v for _, v in want}) == 2
        if forms is plain:
            with duckdb.connect() as con:
                table = df.select("page_id", "url", "html").toPandas()
                con.register("pages", table)
                assert Counter((r[0], r[4]) for r in con.execute(SQL2).fetchall()) == want


def test_owner_tries_spill_between_texts(odd_docs):
    """With a budget so small that every new length and hash spills, the owners are the same."""
    def rows(budget):
        found = exact_dedup.exact_groups(odd_docs, trie_bytes=budget)
        return Counter((r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect())

    assert rows(1) == rows(exact_dedup.TRIE_BYTES)
    texts = sorted([f"{i:03d}" + "x" * (i % 7) for i in range(60)] * 2, key=len)
    batch = {"size": [len(t) for t in texts], "hash": [hash(t) for t in texts], "id": list(range(120)), "rid": list(range(120)),
             "n": [1] * 120, "label": list(range(120)), "text": [t.encode() for t in texts]}
    order = sorted(range(120), key=lambda i: (batch["size"][i], batch["hash"][i]))
    import pyarrow as pa
    batch = {k: pa.array([v[i] for i in order], pa.binary() if k == "text" else pa.int64()) for k, v in batch.items()}
    seen = {}
    for out in exact_dedup._owners(4000)(iter([batch])):
        seen.update(zip(out["label"], zip(out["keep_id"], out["group_size"], strict=True), strict=True))
    assert seen == {i: (min(j for j in range(120) if texts[j] == texts[i]), 2) for i in range(120)}


def test_samples_spread_over_whole_texts(spark):
    df = spark.createDataFrame([("abcdefghijklmnopqrstuvwxyz",), ("abcdefghi",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(common.spread(F.col("t"), 3, 3)).collect()] == ["abc lmn xyz", "abcdefghi", "", None]


def parquet_bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_dedup_leaves_one_copy_of_its_rows(spark, tmp_path):
    """What exact and near dedup store to decide which rows stay is gone once that is known."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 300)) for _ in range(300)]
    rows = [(i, texts[i % 300] if i < 400 else texts[i % 300].replace(" w", " v", 1)) for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    base = Path(common.scratch_dir(spark, "any").removeprefix("file:")).parent
    for drop, left in ((exact_dedup.drop_copies, 400), (near_dedup.drop_near_copies, 300)):
        had = parquet_bytes(base)
        kept = drop(docs)
        own = parquet_bytes(base) - had
        common.numbered(docs)
        copy = parquet_bytes(base) - had - own
        assert copy <= own < 1.2 * copy and kept.count() == left


def test_decided_keeps_outer_tables_only(spark):
    outer = common.stored(spark.range(10).toDF("n"))
    seen = []

    def make():
        inner = common.decided(lambda: common.stored(outer.where("n > 2")).where("n > 3"))
        seen.append(inner)
        return inner.where("n > 4")

    assert common.decided(make).count() == 5 and outer.count() == 10
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        seen[0].collect()


def test_tasks_get_texts_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield {"n": [sum(len(t) for t in b["text"].to_pylist())]}

    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
    got = [r.n for r in common.map_rows(rows, sizes, "n long").collect()]
    assert sum(got) == 15_000_000 and max(got) < 1.5 * common.BATCH_BYTES


def test_a_worker_frees_the_cache_of_another_operator(spark):
    docs = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(str(k)))) for k in range(9)]).alias("text"))

    def cached(batches):
        for b in batches:
            yield {"n": [sum(len(v.pieces) for v in common.kept.values() if isinstance(v, bpe.Encoder))] * len(b["id"])}

    bpe.round_trip_digests(docs, tokenizer_file()).collect()
    cached.__module__ = bpe.__name__
    pieces = common.map_rows(spark.range(0, 1, 1, 1), cached, "n long").first().n
    cached.__module__ = exact_dedup.__name__
    assert pieces in (0, 360) and common.map_rows(spark.range(0, 1, 1, 1), cached, "n long").first().n == 0
    encoder = bpe.encoder_of(tokenizer_file())
    assert bpe.encoder_of(tokenizer_file()) is encoder
    common._taken_over("another")
    assert bpe.encoder_of(tokenizer_file()) is not encoder and bpe.encoder_of(tokenizer_file()).v is encoder.v
