"""Registered corpus queries and the pipeline, stage by stage, against plain Python on whole small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
import corpus_pipeline  # noqa: E402
from doorledger.llm import near_dedup, toxicity  # noqa: E402
from doorledger.llm.catalog import QUERIES, tokenizer_file  # noqa: E402
from doorledger.llm.common import stored  # noqa: E402

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def plain_links(texts, least):
    """Pairs of places whose shingles reach a weighted Jaccard similarity, by comparing all that share one."""
    words = [re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").lower()) for t in texts]
    df = Counter(w for ws in words for w in set(ws))
    idf = {w: 1 + math.log((len(texts) + 1) / (n + 1)) for w, n in df.items()}
    bags, holding = [], defaultdict(list)
    for i, ws in enumerate(words):
        width = min(5, len(ws))
        tf = Counter(tuple(ws[k:k + width]) for k in range(len(ws) - width + 1)) if ws else {}
        bags.append({s: n * sum(idf[w] for w in s) / width for s, n in tf.items()})
        for s in tf:
            holding[s].append(i)
    shared = defaultdict(float)
    for s, places in holding.items():
        for x, i in enumerate(places):
            for j in places[x + 1:]:
                shared[i, j] += min(bags[i][s], bags[j][s])
    total = [sum(b.values()) for b in bags]
    return {(i, j): v / (total[i] + total[j] - v) for (i, j), v in shared.items() if v >= least * (total[i] + total[j] - v)}


def closure(n, pairs):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = top(i), top(j)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def near_copies(seed, n=260):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(9):
        base = list(rng.choice(vocabulary, rng.integers(60, 220)))
        for k in range(n // 10):
            own = list(base if k % 3 else base[:-rng.integers(1, 6)])
            for _ in range(rng.integers(0, 4)):
                own[rng.integers(len(own))] = str(rng.choice(vocabulary))
            texts.append(" ".join(own))
            if k % 5 == 0:
                base = own
    return texts + [" ".join(rng.choice(vocabulary, 90)) for _ in range(n // 10)] + [None, "", "--", "two words", "two words", texts[0]]


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 8)])
def test_near_groups_against_all_pairs(spark, monkeypatch, seed, block):
    """No group without links that hold it together, and at least nine tenths of all links found; also where buckets are cut into blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_copies(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.id: r.component_id for r in near_dedup.near_groups(df).collect()}
    links = plain_links(texts, 0.8 - 1e-4)
    surely = [p for p, s in links.items() if s >= 0.8 + 1e-4]
    whole = closure(len(texts), links)
    inside = closure(len(texts), [p for p in links if found[p[0]] == found[p[1]]])
    assert all(inside[i] == c for i, c in found.items())  # every group hangs together by links
    held = sum(found[i] == found[j] for i, j in surely)
    assert len(surely) > 500 and held >= 0.9 * len(surely) and len(set(whole)) <= len(set(found.values()))
    assert len(set(whole)) < len(texts) - 100


TYPES = {
    "op1_bpe_round_trip": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op3_minhash_near_dedup": "doc_id bigint",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op6_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op7_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op10_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
}


@pytest.fixture(scope="module")
def results(spark):
    kept = {}

    def result(name):
        if name not in kept:
            found = QUERIES[name][0](spark, SMALL)
            kept[name] = (dict(found.dtypes), found.collect())
        return kept[name]
    return result


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


@pytest.mark.parametrize("name", TYPES)
def test_columns_and_types(results, docs, spark, name):
    types, rows = results(name)
    assert {c: types.get(c) for c in dict(x.split() for x in TYPES[name].split(", "))} == dict(x.split() for x in TYPES[name].split(", "))
    if "doc_id" in types and name != "op10_best_fit_packing":
        assert Counter(r.doc_id for r in rows) == Counter(d.doc_id for d in docs)


def test_tokens_of_whole_texts(results, docs):
    library = tokenizers.Tokenizer.from_file(tokenizer_file())
    coded, packed = Counter(), Counter()
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        coded[d.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
        ids.append(1)
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            packed[d.doc_id, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:4] for r in results("op1_bpe_round_trip")[1]) == coded
    rows = results("op10_best_fit_packing")[1]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == packed
    sequences = gapless(rows, 4096)
    assert sequences <= -(-sum(r.length for r in rows) // 4096) + 1


def gapless(rows, capacity):
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for spans in filled.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist() and sum(n for _, n in spans) <= capacity
    return len(filled)


def cut(texts, width=200):
    """Texts without the bytes that a repeated string of ``width`` bytes covers, and the masks."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[k:k + width] for t in raw for k in range(len(t) - width + 1))
    masks = []
    for t in raw:
        mask = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if seen[t[k:k + width]] > 1:
                mask[k:k + width] = b"\1" * width
        masks.append(mask)
    return [bytes(x for x, m in zip(t, mask, strict=True) if not m) for t, mask in zip(raw, masks, strict=True)], masks


def test_repeated_bytes(results, docs):
    kept, masks = cut([d.text for d in docs])
    want = Counter((d.doc_id, len(m), sum(m), len(re.findall(b"\1+", bytes(m))), sha(k)) for d, k, m in zip(docs, kept, masks, strict=True))
    assert Counter(tuple(r)[:5] for r in results("op7_suffix_dedup")[1]) == want


def test_turns_of_all_conversations(results, spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    said = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    want = {}
    for c, own in turns.items():
        own = [(r or "", t or "") for _, r, t in sorted(own, key=lambda x: x[0])]
        loss = "".join(t for r, t in own if r == "assistant")
        want[c] = (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss))
    rows = results("op6_chat_format")[1]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == want and len(rows) == len(want)
    assert all(r.formatted_chars > r.loss_chars for r in rows)


def test_held_out_languages(spark):
    found = QUERIES["op4_language_id"][0](spark, MORE).join(spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in found)
    held = [r for r in found if r.held_out and r.lang is not None and r.lang_pred != "und"]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_held_out_toxicity(spark):
    found = QUERIES["op8_toxicity"][0](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in found)
    held = Counter((r.toxic, r.predicted) for r in found if r.held_out and r.toxic is not None)
    assert held[1, 1] >= 0.85 * (held[1, 0] + held[1, 1]) and held[0, 1] <= 0.02 * (held[0, 0] + held[0, 1])


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """The smallest tables and rows of every odd kind: nulls, empty texts, repeated rows and ids, an extra column."""
    base = tmp_path_factory.mktemp("odd_pipeline")
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = given.orderBy("doc_id").first()
    odd = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " "), (None, "no id " * 40), (10**6 + 3, first.text), (10**6 + 3, first.text), (None, None),
           (10**6 + 4, (first.text or "").replace(" ", " \n", 5)), (10**6 + 5, "Ünïcödé 😀 " * 60)]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], given.select("doc_id", "text", "lang", "source", "n_chars").schema)
    (given.select("doc_id", "text", "lang", "source", "n_chars").union(extra).withColumn("label", F.lit(1)).repartition(3)
     .write.parquet(str(base / "documents.parquet")))
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(str(base / "labels.parquet"))
    return str(base)


def test_pipeline_stage_by_stage(spark, odd_dir):
    now = spark.read.parquet(f"{odd_dir}/documents.parquet")
    columns = now.columns
    before = now.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given, now = now, stored(stage(spark, now, odd_dir))
        after = now.collect()
        assert now.columns == columns and (name == "suffix_dedup" or not Counter(after) - Counter(before))
        if name == "toxicity":
            model = toxicity.train(given, spark.read.parquet(f"{odd_dir}/labels.parquet"))
            scores = model.score([r.text for r in before])
            assert Counter(after) == Counter(r for r, s in zip(before, scores, strict=True) if s < 0.5)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                key = re.sub("[ \t-\r]+", " ", r.text or "")
                order = (r.doc_id is None, r.doc_id or 0)
                best[key] = min(best.get(key, order), order)
            kept = [(re.sub("[ \t-\r]+", " ", r.text or ""), (r.doc_id is None, r.doc_id or 0)) for r in after]
            assert sorted(kept) == sorted(best.items())
        elif name == "near_dedup":
            links = plain_links([r.text for r in before], 0.8 - 1e-4)
            group = closure(len(before), links)
            at = {r: i for i, r in enumerate(before)}
            here = Counter(group[at[r]] for r in after)
            assert set(here) == set(group) and sum(here.values()) - len(here) <= 0.1 * len(links)
        else:
            kept, _ = cut([r.text for r in before])
            want = Counter((r.doc_id, None if r.text is None else k.decode("utf-8", "ignore")) for r, k in zip(before, kept, strict=True))
            assert Counter((r.doc_id, r.text) for r in after) == want
        before = after
    library = tokenizers.Tokenizer.from_file(tokenizer_file())
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, odd_dir).collect()
    gapless(pieces, 4096)
    total = defaultdict(int)
    for r in pieces:
        total[r.doc_id] += r.length
    want = defaultdict(int)
    for r in before:
        want[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    assert total == want
    again = Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, odd_dir).collect())
    assert again == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in pieces)


def test_pipeline_of_nothing(spark, odd_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
