"""The ten operators against brute force, and their edge cases."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heliograph.llm import (
    chat_format, curriculum, exact_dedup, jaccard_join, packing, perplexity, quality_crf, textvec, token_ids, token_store, url_filter, warc,
)
from heliograph.llm.catalog import oracle_sql, queries, tokenizer_path
from heliograph.runtime import fresh_path, saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string, score double, key long"


def frame(spark, texts, **more):
    """Documents with clashing extra columns; texts are (doc_id, text) or text alone."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    langs, sources = more.get("langs", ["en"] * len(rows)), more.get("sources", ["s"] * len(rows))
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "x", 0.5, 7) for (i, t), l, s in zip(rows, langs, sources)], DOCS).repartition(2)


ODD = [None, "", "  \n\t ", "one", "one", "two words", "a " * 5000, "ünï çødé ÀB é", "x\u00a0y \u2003z", "end\n\n\nmore  ", "<|endoftext|> a.b, c.\nNext", (3, "one"), (None, "null id"), (None, None)]


# 1 -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(spark)


def test_url_rules_against_brute_force(spark, url_model):
    urls = ["http://a.org/x", "http://EXAMPLE.org/es/1", "https://sub.example.org/en/1?q", "http://example.org/en/2", "http://x.com/fr/1", "http://x.com/de/#a",
            "http://org/", "http://notorg/x", "http://x.org", "nonsense", None, "", "a://b://c/d", "http://x.com?fr=/fr/", "http://é.ORG/é"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.judge(pages, model=url_model).collect()}
    assert len(got) == len(urls)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            raw = re.match(r"[^/?#]*", rest)[0]
            host, path = raw.translate(low), re.match(r"[^?#]*", rest[len(raw):])[0]
        fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda x: len(x[0]), default=(None, None))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best[0]), u
        assert got[i].verdict == (best[1] or ("block" if got[i].score >= 0.5 else "allow"))


def test_url_model_scores_like_its_formula_and_separates(spark, url_model):
    pages = spark.createDataFrame([(1, "http://www.casino-win.example.net/en/7"), (2, "http://blog.tionsh.example.net/en/7"), (3, "http://free-bets.example.com/en/1"), (4, "https://thther.example.com/en/9")], "page_id long, url string")
    got = {r.page_id: r.score for r in url_filter.judge(pages, rules=[], model=url_model).collect()}
    assert got[1] > 0.5 and got[3] > 0.5 and got[2] < 0.5 and got[4] < 0.5
    grams = url_filter.with_grams(url_filter._split(pages)).select("_grams").first()[0]
    host = "^www.casino-win.example.net$"
    assert grams[: len(host) - 2] == ["h3" + host[i : i + 3] for i in range(len(host) - 2)]


def test_url_model_on_hosts_it_has_not_seen(spark):
    """Five folds by host: the held-out hosts and their URLs are in no training row."""
    hosts = sorted(url_filter.labelled_hosts())
    np.random.default_rng(1).shuffle(hosts)
    right = {0: 0, 1: 0}
    for fold in range(5):
        model = url_filter.train(spark, url_filter.labelled_urls([(h, int(x), k) for i, (h, x, k) in enumerate(hosts) if i % 5 != fold]))
        pages = spark.createDataFrame([(i, f"http://{h}/news/1") for i, (h, _, _) in enumerate(hosts) if i % 5 == fold], "page_id long, url string")
        for r in url_filter.judge(pages, rules=[], model=model).collect():
            label = int(hosts[r.page_id][1])
            right[label] += (r.score >= 0.5) == (label == 1)
    count = {x: sum(int(h[1]) == x for h in hosts) for x in (0, 1)}
    assert right[1] > 0.4 * count[1] and right[0] > 0.8 * count[0], (right, count)


def test_url_bounds_and_empty(spark, url_model):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), model=url_model).count() == 0
    with pytest.raises(ValueError):
        url_filter.train(spark, [("http://a/", 0)] * 3, max_rows=2)
    with pytest.raises(ValueError):
        url_filter.rule_column([("a", "/", "allow")] * 501, "rule")


# 2 -----------------------------------------------------------------------------------------------

def brute_marginals(good, step):
    """P(good) per line by summing over all label sequences."""
    from itertools import product

    n, total, out = len(good), 0.0, np.zeros(len(good))
    for ys in product((0, 1), repeat=n):
        p = np.prod([good[i] if y else 1.0 for i, y in enumerate(ys)]) * np.prod([step[a, b] for a, b in zip(ys, ys[1:])])
        total += p
        out += p * np.asarray(ys)
    return out / total


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    lengths = [3, 1, 5, 2]
    doc = np.repeat(np.arange(4), lengths)
    x = rng.normal(size=(len(doc), 3))
    field = quality_crf.Field(rng.normal(size=3), rng.normal(size=(2, 2)))
    p = field.marginals(doc, x)
    for d in range(4):
        assert np.allclose(p[doc == d], brute_marginals(np.exp(x[doc == d] @ field.weights), np.exp(field.follow)))


def test_crf_gradient_fits_separable_lines():
    rng = np.random.default_rng(2)
    doc = np.repeat(np.arange(40), 4)
    label = np.arange(40) % 2
    x = np.concatenate([np.ones((160, 1)), label[doc][:, None] * 2 - 1 + rng.normal(scale=0.3, size=(160, 1))], axis=1)
    field = quality_crf.fit(doc, x, label, steps=80)
    assert ((field.marginals(doc, x) > 0.5) == (label[doc] == 1)).mean() > 0.95


def test_quality_edge_cases_and_held_out(spark):
    docs = frame(spark, ODD + ["Good text here. It is fine.\nAnother line."] * 5 + ["BAD!! LOUD!! TEXT!!"] * 5)
    labels = spark.createDataFrame([(i, int(i < 19), 0) for i in range(14, 24)] + [(14, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_crf.classify(docs, labels).collect()
    assert len(rows) == len(ODD) + 10
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    none = quality_crf.classify(docs, labels.where("false")).collect()
    assert all(r.score == 1.0 for r in none)
    assert quality_crf.classify(docs.where("false"), labels).count() == 0


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    scored = queries()["op2_quality_crf"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    good, n = scored.selectExpr("sum(int(predicted = quality))", "count(*)").first()
    assert good / n >= 0.95


# 3 -----------------------------------------------------------------------------------------------

def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[body])
        out.append((i, best[3], len(groups[body]), i == best[3] and -len(t or "") == best[0], hashlib.sha256(body.encode()).hexdigest()))
    return out


def listed(rows):
    return sorted([tuple(r) for r in rows], key=str)


@pytest.mark.parametrize("capacity,depth,bits", [(1 << 16, 16, 60), (1, 3, 60), (2, 8, 60), (1, 3, 4)])
def test_exact_dedup_against_brute_force(spark, capacity, depth, bits):
    """Also with keys of 4 bits, so that chains hold different texts."""
    texts = ODD + ["a b c", "abc", "a\tb\nc  ", "abd"] + [f"t{i % 7} x" for i in range(30)]
    docs = frame(spark, texts)
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    got = exact_dedup.dedup(docs, capacity, depth, bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert listed(got) == listed(brute_dedup(rows))


def test_directory_splits_overfull_buckets_only(spark):
    keys = [(k << 57) | 5 for k in (0, 0, 0, 1, 4)] + [(6 << 57) | i for i in range(4)]
    rows = spark.createDataFrame([(k,) for k in keys], "key long").selectExpr("key")
    slots = {r.cell: (r.local_depth, r.bucket) for r in exact_dedup.directory(rows, capacity=3, max_depth=3).collect()}
    assert slots[0] == (3, 0) and slots[1] == (3, 1)  # halves of an overfull quarter
    assert slots[4][0] == 2 and slots[6] == (3, 6)  # fits at depth 2; overfull at the last depth


def test_index_chains_collisions_by_bytes_and_owners_take_key_ranges(spark):
    docs = frame(spark, [f"t{i % 40}" for i in range(200)])
    index, slots = exact_dedup.build_index(docs, capacity=4, max_depth=3, key_bits=4)
    rows, cells = index.collect(), slots.collect()
    assert len(rows) == 40 and sum(r.group_size for r in rows) == 200
    chains = defaultdict(list)
    for r in rows:
        chains[r.key].append((r.chain, r.text_sha256))
    assert len(chains) <= 16 and max(map(len, chains.values())) > 1
    for chain in chains.values():
        assert sorted(c for c, _ in chain) == list(range(len(chain))) and len({s for _, s in chain}) == len(chain)
    held = {r.bucket: r.owner for r in cells}
    assert all(held[r.bucket] == r.owner for r in rows)
    small = exact_dedup.directory(spark.range(64).selectExpr("id as key"), capacity=4, max_depth=5, key_bits=6, owned=16).orderBy("cell").collect()
    assert [r.owner for r in small] == sorted(r.owner for r in small) and len({r.owner for r in small}) == 4
    assert {r.local_depth for r in small} == {4}


def test_probes_need_the_directory(spark):
    docs = frame(spark, ["a b", "ab", "c", "d"])
    index, slots = exact_dedup.build_index(docs)
    marked = docs.selectExpr("doc_id", "sha2(replace(text, ' ', ''), 256) as __sha")
    assert exact_dedup._probe(marked, index, slots, 16, 60).count() == 4
    assert exact_dedup._probe(marked, index, slots.where("false"), 16, 60).count() == 0
    assert exact_dedup._probe(marked, index, slots.withColumn("bucket", slots.bucket + 1), 16, 60).count() == 0


def test_exact_dedup_survivors(spark):
    texts = ["a b", "ab", "a  b", "c", (3, "c"), None, ""]
    docs = frame(spark, texts)
    kept = exact_dedup.survivors(docs).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3, 5] and set(kept[0].asDict()) == set(docs.columns)
    assert exact_dedup.survivors(docs.where("false")).count() == 0


# 4 -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(list("ab.,' \n\t\u00a0é1!<|") + ["  ", "\n\n", "it's", "<|endoftext|>", "日"]), max_size=40).map("".join))
def test_pieces_have_the_librarys_ids(text):
    encode = token_ids.encoder(tokenizer_path())
    assert "".join(token_ids.split(text)) == text
    want = encode.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode.ids(text), "<u4").tolist() == want
    assert [np.frombuffer(x, "<u4").tolist() for x in encode.many([text, "", text + "b c\nd."])][0] == want


def test_blocks_have_the_librarys_ids(spark, library, monkeypatch):
    monkeypatch.setattr(textvec, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(token_ids, "YOUNG_PIECES", 50)
    monkeypatch.setattr(token_ids, "MEMO_PIECES", 2000)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [t[1] or "" if isinstance(t, tuple) else t or "" for t in ODD]
    own = token_ids.Encoder(tokenizer_path())
    for at in range(0, len(texts), 60):
        part = texts[at : at + 60]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.many(part)] == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_memo_may_overflow(monkeypatch, library):
    monkeypatch.setattr(token_ids, "MEMO_PIECES", 8)
    own = token_ids.Encoder(tokenizer_path())
    for k in range(20):
        text = " ".join(f"word{k}x{j}." for j in range(6))
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packing_covers_every_id_without_gaps(spark, library, capacity):
    texts = ODD + ["word " * n for n in (1, 15, 16, 17, 100, 3000)]
    docs = frame(spark, texts)
    rows = packing.pack(docs, tokenizer_path(), capacity).collect()
    ids = defaultdict(list)
    for i, t in [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]:
        ids[i].append(library.encode(t or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for doc, whole in ids.items():
        if len(whole) == 1:
            assert sum((x for _, x, _ in sorted(pieces[doc])), []) == whole[0]
        assert sum(len(x) for _, x, _ in pieces[doc]) == sum(map(len, whole))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0  # full, or a power of two: no padding at all
    assert packing.pack(docs.where("false"), tokenizer_path()).count() == 0


def packed_by_one_worker(sizes, capacity=2048):
    worker = packing.Worker(0, capacity)
    for i, n in enumerate(sizes):
        worker.add(i, bytes(4 * n))
    worker.close()
    sequences = defaultdict(list)
    for doc, start, length, ids, tokens, seq, at in worker.done:
        assert len(ids) == 4 * length and tokens == sizes[doc]
        sequences[seq].append((at, doc, start, length))
    return [sorted(x) for x in sequences.values()]


def test_bins_hold_their_class_whole_and_long_documents_fill_them():
    rng = np.random.default_rng(2)
    sizes = np.concatenate((rng.lognormal(6.5, 1.1, 4000).astype(int) + 1, rng.integers(1, 30, 300))).clip(1, 40_000)
    rng.shuffle(sizes)
    sequences = packed_by_one_worker(sizes.tolist())
    pieces = defaultdict(list)
    for parts in sequences:
        for _, doc, start, length in parts:
            pieces[doc].append((start, length))
    for doc, cut in pieces.items():
        assert [a for a, _ in sorted(cut)] == np.cumsum([0] + [n for _, n in sorted(cut)])[:-1].tolist() and sum(n for _, n in cut) == sizes[doc]
    assert all((n := sum(x[3] for x in parts)) == 2048 or n & (n - 1) == 0 for parts in sequences)
    small = [d for d in pieces if sizes[d] <= 2048]
    assert sum(len(pieces[d]) > 1 for d in small) < 0.01 * len(small)
    counts = [[2048 // sizes[d] for _, d, _, _ in parts if sizes[d] <= 2048] for parts in sequences]
    assert sum(len(set(c)) <= 1 and len(c) in (0, *c[:1]) for c in counts) > 0.98 * len(counts)  # m documents of class m


@given(st.lists(st.integers(1, 70), max_size=60), st.sampled_from([1, 2, 16]))
@settings(max_examples=200, deadline=None)
def test_any_lengths_leave_no_padding(sizes, capacity):
    sequences = packed_by_one_worker(sizes, capacity)
    assert sum(x[3] for parts in sequences for x in parts) == sum(sizes)
    for parts in sequences:
        n = sum(x[3] for x in parts)
        assert n <= capacity and n & (n - 1) == 0
        assert [x[0] for x in parts] == np.cumsum([0] + [x[3] for x in parts])[:-1].tolist()


def test_waiting_bins_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "WAITING", 4)
    worker = packing.Worker(0, 2048)
    for i in range(500):
        worker.add(i, bytes(4 * 1500))
        assert len(worker.waiting) <= 4 and worker.spare_tokens < 1 << 18
    worker.close()
    assert sum(x[2] for x in worker.done) == 500 * 1500
    with pytest.raises(ValueError):
        packing.pack(None, "", 100)


# 5 -----------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, tmp_path):
    big, html = "é" * 600, "<p>x</p>\r\n\r\n"
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (5, None, big), (3, "u", html), (4, "u", html), (6, "u", None), (7, "u", ""), (None, "n", "w" * 2000), (8, "n", "w" * 2000), (9, "d", "z" * 1000), (9, "d", "z" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as payload", "1 as sha256")
    got = {(r.page_id, r.record_type, r.refers_to): r for r in warc.report(pages).collect()}
    assert {k for k in got} == {(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (3, "response", None), (4, "response", None), (6, "response", None),
                                (7, "response", None), (None, "revisit", 8), (8, "response", None), (9, "response", None)}
    assert got[1, "revisit", 5].payload_digest == hashlib.sha1(big.encode()).hexdigest() and got[1, "revisit", 5].payload_bytes == 1200
    heads, payloads = warc.write_archive(pages)
    assert payloads.count() == 5 and heads.count() == len(rows)
    whole = sorted(bytes(r.record) for r in warc.reconstruct(heads, payloads).collect())
    warc.export_warc(heads, payloads, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    assert len(data) == sum(map(len, whole)) and all(x in data for x in whole)
    for record in whole:
        head, block = record.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert int(re.search(rb"Content-Length: (\d+)", head)[1]) == len(block) - 4
    broken = payloads.selectExpr("sha256", "cast('other' as binary) as payload", "size")
    with pytest.raises(Exception, match="digest mismatch"):
        warc.reconstruct(heads, broken).collect()
    assert warc.report(pages.where("false")).count() == 0


# 6 -----------------------------------------------------------------------------------------------

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full, free = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        level = (total - sum(full.values())) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: full.get(s, level * weight[s] if s in free else 0) for s in order}
        full |= {s: 2.0 * sizes[s] for s in over}
        free -= over


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(3)
    texts = ["w " * int(n) for n in rng.integers(0, 60, 300)] + [None, ""]
    sources = [["a", "b", None, "é", "z"][int(x)] for x in rng.choice(5, 302, p=[0.4, 0.05, 0.2, 0.05, 0.3])]
    docs = frame(spark, texts, sources=sources)
    rows = curriculum.mix(docs).collect()
    assert len(rows) == 302 and listed(rows) == listed(curriculum.mix(docs).collect())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        assert r.size == len(WORD.findall(texts[r.doc_id] or ""))
    goal = brute_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    positions = [r.position for r in rows if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_schedule_inversion_is_the_inverse_of_the_integral(spark):
    from pyspark.sql import functions as F

    for slot, phases in enumerate(curriculum.SCHEDULES):
        got = spark.range(0, 21).select((F.col("id") / 20).alias("f")).select("f", curriculum.time_of(F.col("f"), F.lit(slot)).alias("t")).collect()
        for r in got:
            edges = np.linspace(0, 1, len(phases) + 1)
            done = sum(h * max(0, min(r.t, b) - a) for h, a, b in zip(phases, edges, edges[1:]) if r.t > a) / len(phases) * len(phases)
            assert abs(done - r.f) < 1e-9


def test_mixed_documents(spark):
    docs = frame(spark, ["w " * 10] * 20 + ["v " * 10] * 40 + [None], sources=["a"] * 20 + ["b"] * 40 + ["b"])
    rows = curriculum.mixed_documents(docs).collect()
    assert set(rows[0].asDict()) == set(docs.columns)
    counts = defaultdict(int)
    for r in rows:
        counts[r.source] += 1
    assert counts == {"a": 40, "b": 50}  # twice the first source, the rest from the second
    assert curriculum.mix(docs.where("false")).count() == 0


# 7 -----------------------------------------------------------------------------------------------

def brute_base(text):
    words = WORD.findall(text or "")
    seen, dup, where = set(), 0, defaultdict(list)
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    for i in range(len(words) - 7):
        where[tuple(words[i : i + 8])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_counts_against_brute_force():
    texts = [t[1] if isinstance(t, tuple) else t for t in ODD] + ["a b c d e f g h i\n" * 3, "l1\nl2\nl1\n\nl1 \nl1", "# é|b <x>\r\n&&", "r " * 9 + "s " + "r " * 9]
    for block in ([x] for x in texts), [texts]:
        for part in block:
            got = [perplexity.base_counts(data, starts) for _, _, data, starts in textvec.blocks([None if t is None else t.encode() for t in part])]
            rows = [tuple(int(g[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for g in got for i in range(len(g["n_words"]))]
            assert rows == [brute_base(t) for t in part]


def test_kneser_ney_sums_to_one_and_backs_off(spark):
    docs = frame(spark, ["abcab abcabd", "aab bca cab", "dab"] * 3)
    table = {(r.kind, r.key): r.logp for r in perplexity.kneser_ney(perplexity.count_grams(docs)).collect()}
    contexts = defaultdict(float)
    for (kind, key), logp in table.items():
        if kind == perplexity.ORDER:
            contexts[key >> 12] += np.exp(logp)
    assert all(0 < p <= 1 + 1e-9 for p in contexts.values())
    model = perplexity.build_model(docs)
    lang = np.asarray([zlib.crc32(b"en") % 4096])
    keys, _ = perplexity.gram_keys([b"abcab", b"zzzzz"], np.repeat(lang, 2))
    lp = model.log_probabilities(keys)
    assert (lp[:5] > lp[5:].max()).all() and np.isfinite(lp).all()
    for key, value in zip(keys[:5], lp[:5]):
        assert abs(table[perplexity.ORDER, int(key)] - value) < 1e-4


def test_keys_are_sparks_hash(spark):
    from pyspark.sql import functions as F

    keys = np.asarray([0, 1, 17, 1 << 40, (1 << 62) + 12345], np.int64)
    got = [r[0] for r in spark.createDataFrame([(int(k), int(k) // 3) for k in keys], "k long, l long").select(F.xxhash64("k", "l")).collect()]
    assert got == perplexity.hash_longs(keys, keys // 3).tolist()


def test_labelled_junk_is_rejected_and_clean_documents_stay(spark):
    """On the labelled documents of sf0.01 that pass the base rules."""
    d = "/root/testdata/sf0.01"
    rows = perplexity.rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    found = {(r.quality, r.kept): r.n for r in rows.where("not base_failed").groupBy("quality", "kept").count().withColumnRenamed("count", "n").collect()}
    good, bad = (found.get((q, True), 0) + found.get((q, False), 0) for q in (1, 0))
    assert found.get((0, False), 0) >= 0.55 * bad and found.get((1, False), 0) <= 0.03 * good, found


def test_rules_edge_cases(spark):
    rng = np.random.default_rng(4)
    clean = [" ".join(rng.choice("the of and in to is that for it was on are with as his they at be this from".split(), 60)) for _ in range(60)]
    docs = frame(spark, ODD + clean + ["qzxj " * 40], langs=(["en", None, "fr", "de"] * 20)[: len(ODD)] + ["en"] * 60 + ["en"])
    rows = {(r.doc_id, r.n_words, r.word_chars): r for r in perplexity.rules(docs).collect()}
    assert sum(1 for _ in rows) >= 70
    for r in rows.values():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
        if r.n_words == 60:
            assert r.kept and r.lower_bound <= r.perplexity <= r.upper_bound
    assert perplexity.rules(docs.where("false")).count() == 0


def test_wide_scripts_and_languages_stay_apart(spark):
    # 2,500 Hangul and Han characters and two languages of one CRC: none may share an n-gram's entry
    wide = [chr(0xAC00 + i) + chr(0x4E00 + i) + chr(0x1F300 + i % 500) for i in range(2500)]
    texts = ["".join(wide[i : i + 250]) for i in range(0, 2500, 250)] + ["abcab"] * 3 + ["xyxy"] * 2 + [None, ""]
    one, seen = None, {}
    for i in range(10_000):
        if (one := seen.setdefault(zlib.crc32(b"l%d" % i) % 4096, i)) != i:
            break
    docs = frame(spark, texts, langs=["ko"] * 10 + [f"l{one}"] * 3 + [f"l{i}"] * 2 + [None, "ko"])
    grams = perplexity.count_grams(docs).collect()
    want = defaultdict(int)
    for k, t in enumerate(texts):
        lang = 0 if k < 10 else 1 if k < 13 else 2
        for e in range(len(t or "")):
            want[lang, ("\x03" * (perplexity.ORDER - 1) + t)[e : e + perplexity.ORDER]] += 1
    assert sorted(r["count"] for r in grams) == sorted(want.values())
    sent = {r.doc_id: r.nll for r in perplexity.measured(docs).collect()}
    joined = {r.doc_id: r.nll for r in perplexity.measured(docs, shared=0, chunk_bytes=2000).collect()}
    assert sent.keys() == joined.keys() and len(sent) == len(texts)
    assert all(abs(sent[k] - joined[k]) < 1e-6 for k in sent)


def test_bands_reject_junk_that_passes_the_base_rules(spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(300)]
    say = lambda n: [words[i] for i in (300 * rng.random(n) ** 2).astype(int)]
    clean = [" ".join(say(int(n))) for n in rng.integers(40, 400, 400)]
    marks = [" ".join(w + rng.choice(["&&&", "***", "%%%"]) for w in say(100)) for _ in range(6)]
    bars = [" | ".join(say(100)) for _ in range(6)]
    mixed = ["".join(rng.permutation(list(" ".join(say(100))))) for _ in range(6)]
    copies = [clean[0]] * 500  # more than half of the rows: they must not narrow the band
    rows = {r.doc_id: r for r in perplexity.rules(frame(spark, clean + marks + bars + mixed + copies)).collect()}
    order = sorted(rows)
    assert not any(r.base_failed for r in rows.values())
    assert sum(rows[i].kept for i in order[:400]) >= 392
    assert [i for i in order[400:418] if rows[i].kept] == []


# 8 -----------------------------------------------------------------------------------------------

def shingles(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), None if doc is None else doc if not sets[i] else least[find(i)]) for i, (doc, _) in enumerate(rows)]


def near_copies(rng, n_groups=25):
    """Groups whose members differ by edits around the limit, of all sizes."""
    texts = []
    for g in range(n_groups):
        n = int(rng.choice([4, 5, 6, 8, 9, 12, 20, 45, 120, 300]))
        base = [f"w{rng.integers(0, 10**6)}" for _ in range(n)]
        for _ in range(int(rng.integers(2, 7))):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 20)))):
                at, kind = int(rng.integers(0, len(copy))), rng.integers(0, 3)
                if kind == 0:
                    copy[at] = f"e{rng.integers(0, 10**6)}"
                elif kind == 1:
                    copy.insert(at, "ins")
                elif len(copy) > 1:
                    del copy[at]
            if rng.random() < 0.3:
                copy = copy + [f"t{rng.integers(0, 9)}" for _ in range(int(rng.integers(1, 3)))]
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard_join_against_brute_force(spark, seed):
    texts = ODD + ["One", "ONE two three four five six", "one two three four five six", "É é é é é", "é é é é é"] + near_copies(np.random.default_rng(seed))
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    got = jaccard_join.join(frame(spark, texts)).collect()
    assert listed(got) == listed(brute_components(rows))


def test_signatures_meet_for_all_links():
    """The pigeonhole: linked sets share a signature, whatever their sizes, with and without heat."""
    rng = np.random.default_rng(7)
    for heat in (jaccard_join.Heat(np.zeros(0, np.uint64), np.zeros(0, np.int64)), None):
        for _ in range(1500):
            n = int(rng.choice([4, 5, 6, 7, 8, 9, 10, 12, 15, 16, 19, 20, 33, 64, 79, 80]))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            keep = a[rng.random(len(a)) > rng.choice([0, 0.05, 0.1])]
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 5) + 1)), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common) or np.array_equal(a, b):
                continue
            h = heat or jaccard_join.Heat(a[::2], rng.integers(1, 99, len(a[::2])))
            x, y = (np.concatenate(jaccard_join.signatures(t, h) or [np.zeros(0, np.uint64)]) for t in (a, b))
            assert len(np.intersect1d(x, y)), (len(a), len(b), common)


def test_hot_passage_and_second_round(spark):
    """Many unlike documents share a passage; a cluster's members link through others only."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [passage + " " + " ".join(f"u{rng.integers(0, 10**6)}" for _ in range(20)) for _ in range(60)]
    chain = [f"c{i}" for i in range(60)]
    for k in range(12):  # each link drops two words in front and adds two behind
        texts.append(" ".join(chain[2 * k :] + [f"d{i}" for i in range(2 * k)]))
    rows = list(enumerate(texts))
    assert listed(jaccard_join.join(frame(spark, texts)).collect()) == listed(brute_components(rows))


def test_group_pass_over_batches(spark):
    rows = [(s, n) for s in range(40) for n in range(1 + s % 3 * 30)] * 2
    index = spark.createDataFrame(rows, "sign long, node long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, jaccard_join.groups(index).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted((s, n, n) for s, n in set(rows) if s % 3)


def varied(rng, words, edits):
    words = list(words)
    for k in rng.choice(len(words), edits, replace=False):
        words[k] = f"e{rng.integers(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [4096, 16])
def test_one_large_group_of_near_copies(spark, monkeypatch, block):
    """Copies of one text at all distances, so that many of the group's pairs link and many don't; also in several blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = np.random.default_rng(17)
    base = [f"w{i}" for i in range(150)]
    texts = [varied(rng, base, int(rng.integers(2, 9))) for _ in range(150)]
    rows = list(enumerate(texts))
    got = jaccard_join.join(frame(spark, texts)).collect()
    assert listed(got) == listed(brute_components(rows))
    assert 3 < len({r.component_id for r in got}) < 150


def test_large_group_proposes_in_proportion(spark):
    """A group of n nodes that link densely proposes about n pairs, not n * n."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(300) > 0.02], rng.integers(0, 1 << 62, 3).astype(np.uint64)))) for _ in range(200)]
    table = pa.table({
        "sign": np.ones(200, np.int64), "cell": np.zeros(200, np.int64), "role": np.zeros(200, np.int64), "node": np.arange(200), "comp": np.arange(200),
        "n_shingles": [len(s) for s in sets], "block": np.zeros(200, np.int64), "parity": pa.array([jaccard_join.parities(s) for s in sets], pa.binary()),
        "wide": pa.array([jaccard_join.wide_parities(s) for s in sets], pa.binary())})
    assert len(jaccard_join.Members(table).proposals(1)[0]) == 199


def test_wide_parities_bound_the_difference():
    rng = np.random.default_rng(4)
    for n, shared in ((5000, 0), (5000, 4800), (900, 700), (600, 590)):
        common = rng.integers(0, 1 << 62, shared).astype(np.uint64)
        a, b = (np.unique(np.concatenate((common, rng.integers(0, 1 << 62, k).astype(np.uint64)))) for k in (n - shared, int(1.05 * n) - shared))
        least = jaccard_join.least_difference(jaccard_join.wide_parities(a), jaccard_join.wide_parities(b))
        assert least <= len(np.setxor1d(a, b))
        assert (least > (len(a) + len(b)) // 9) == (shared == 0 or n == 900), (n, shared)
    assert jaccard_join.wide_parities(common[:512]) is None


def test_long_documents(spark):
    """Documents of some 5,000 shingles: copies that link, copies that don't, and unlike ones."""
    rng = np.random.default_rng(23)
    base = [f"w{rng.integers(0, 10**7)}" for _ in range(5000)]
    texts = [varied(rng, base, k) for k in (20, 60, 95, 130, 200, 400)] + [" ".join(f"v{rng.integers(0, 10**7)}" for _ in range(5000)) for _ in range(4)]
    assert listed(jaccard_join.join(frame(spark, texts)).collect()) == listed(brute_components(list(enumerate(texts))))


def test_jaccard_representatives_and_empty(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "x y z w v u", None])
    assert sorted(r.doc_id for r in jaccard_join.representatives(docs).collect()) == [0, 2, 3]
    assert jaccard_join.join(docs.where("false")).count() == 0


# 9 -----------------------------------------------------------------------------------------------

def test_token_files_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(token_store, "FRAME_BYTES", 200)
    texts = ODD[:11] + [f"document {i} has its own words {i * i}" for i in range(60)]
    docs = frame(spark, texts)
    path = fresh_path(spark, "t")
    token_store.write(docs, tokenizer_path(), path, file_bytes=2000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read(spark, path).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert got[i] == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    found = token_store.lookup(spark, path, [3, 20])
    assert found[20] == library.encode(texts[20], add_special_tokens=False).ids + [0] and set(found) == {3, 20}


def test_token_files_odd_ids_and_empty(spark):
    rows = token_store.report(frame(spark, ODD), tokenizer_path()).orderBy("start").collect()
    assert len(rows) == len(ODD) and rows[0].doc_id is None and rows[0].start == 0
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    path = fresh_path(spark, "t")
    token_store.write(frame(spark, ODD).where("false"), tokenizer_path(), path)
    assert token_store.read(spark, path).count() == 0


def test_dictionary_is_checked():
    blob = token_store.frame([(1, 2, b"xy"), (None, 3, b"z")], b"dict")
    at, tokens, index, blobs = next(token_store.read_frames(blob + b"\n", b"dict"))
    assert tokens == 5 and index["first"].tolist() == [0, 2] and index["has_id"].tolist() == [1, 0] and bytes(blobs) == b"xyz"
    with pytest.raises(ValueError):
        next(token_store.read_frames(blob, b"other"))


def test_there_is_always_a_dictionary():
    import zstandard

    for samples in ([], [b"ab"], [b"abcdefgh" * 10] * 3, [bytes([i]) * 300 for i in range(20)]):
        d = token_store._zstd(token_store.train_dictionary(samples))
        blob = zstandard.ZstdCompressor(dict_data=d).compress(b"abcdefgh" * 9)
        assert zstandard.ZstdDecompressor(dict_data=d).decompress(blob) == b"abcdefgh" * 9


def test_samples_reach_over_whole_documents():
    ids = np.arange(200_000, dtype="<u4").tobytes()
    blocks = token_store.sample_blocks(ids, 4, 7)
    assert [len(b) for b in blocks] == [token_store.BLOCK_BYTES] * token_store.SAMPLE_BLOCKS
    places = [np.frombuffer(b, "<u4") for b in blocks]
    assert all((np.diff(p) == 1).all() and k * 50_000 <= p[0] < (k + 1) * 50_000 for k, p in enumerate(places))
    assert token_store.sample_blocks(b"abcd", 2, 1) == [b"abcd"]


def test_dictionary_helps_short_documents(library):
    import zstandard

    texts = [f"the quick brown fox number {i} jumps over the lazy dog again and again" for i in range(6000)]
    samples = [np.asarray(library.encode(t).ids, "<u2").tobytes() for t in texts]
    d = token_store.train_dictionary(samples)
    assert d and len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)).compress(samples[0])) < len(zstandard.ZstdCompressor().compress(samples[0]))


# 10 ----------------------------------------------------------------------------------------------

CHATS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\/s>", "<|im_start|>user<|im_sep|>x<|im_end|>", "a\\\\<|im_sep|>", "<|im_", None, "", "é\n\\n", "[/INST]<s>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, 0, "user", "only")] + [(3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (3, None, None, "none"), (None, 1, "assistant", "x"), (4, 1, "<|im_sep|>", "r")]
    chats = spark.createDataFrame(rows, CHATS).selectExpr("*", "'clash' as formatted")
    out = saved(chat_format.examples(chat_format.with_probe(chats)), "chat")
    got = {r.conv_id: r for r in chat_format.report(out).collect()}
    every = rows + [(-1, 0, "user", chat_format.PROBE), (-1, 1, "assistant", chat_format.PROBE)]
    for conv in {r[0] for r in every}:
        turns = sorted(((t is not None, t or 0, ro or "", tx or "") for c, t, ro, tx in every if c == conv))
        shown = "".join(f"{ro}\n{tx}\n" for _, _, ro, tx in turns)
        loss = "".join(tx for _, _, ro, tx in turns if ro == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(shown.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in out.where("trainable").collect():
        assert r.formatted[r.loss_start + r.loss_length :] == chat_format.END
    assert chat_format.report(chat_format.examples(chats.where("false"))).count() == 0


def test_chat_context_is_all_that_precedes(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (1, 4, "assistant", "b"), (1, 5, "user", "w")]
    out = chat_format.examples(spark.createDataFrame(rows, CHATS)).orderBy("example").collect()
    turn = lambda role, text: f"<|im_start|>{role}<|im_sep|>{text}<|im_end|>"
    whole = [turn(r, t) for _, _, r, t in rows]
    assert [r.formatted for r in out] == ["".join(whole[:3]), "".join(whole[:5]), "".join(whole)]
    assert [r.formatted[r.loss_start : r.loss_start + r.loss_length] for r in out] == ["a", "b", ""]


# The queries against DuckDB, and the pipeline ---------------------------------------------------------

@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.execute(oracle_sql()[name])
    names = sorted(x[0] for x in want.description)
    rows = want.fetchall()
    order = [[x[0] for x in want.description].index(n) for n in names]
    got = queries()[name](spark, d)
    assert sorted(got.columns) == names
    assert listed(got.select(*names).collect()) == listed([tuple(r[i] for i in order) for r in rows])


def test_pipeline_with_repeated_ids_against_brute_force(spark):
    """Repeated doc_ids, equal rows and clashing columns through exact, near, mixing and packing."""
    import corpus_pipeline

    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i // 2 if i < 20 else i, varied(rng, base, 1 + i % 3) if i % 4 else f"text {i} " * 8) for i in range(40)] + [(3, "same id, other text"), (None, "no id"), (None, None), (8, "")]
    rows += rows[:6]
    docs = frame(spark, rows, sources=["s" if i % 3 else "t" for i in range(len(rows))])
    listed_rows = [(r.doc_id, r.text) for r in docs.collect()]
    exact = saved(corpus_pipeline.exact(spark, docs, ""), "exact")
    assert exact.columns == docs.columns
    kept = {(r[0], t) for r, (_, t) in zip(brute_dedup(listed_rows), listed_rows) if r[3]}
    assert sorted([(r.doc_id, r.text) for r in exact.collect()], key=str) == sorted(kept, key=str)
    near = saved(corpus_pipeline.near(spark, exact, ""), "near")
    pairs = [(r.doc_id, r.text) for r in exact.collect()]
    sets, parent = [shingles(t) for _, t in pairs], list(range(len(pairs)))
    linked = lambda a, b: sets[a] and sets[b] and None not in (pairs[a][0], pairs[b][0]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    for _ in pairs:
        parent = [min(parent[b] for b in range(len(pairs)) if a == b or linked(a, b)) for a in range(len(pairs))]
    groups = defaultdict(list)
    for k, p in enumerate(parent):
        groups[p].append(pairs[k])
    got = [(r.doc_id, r.text) for r in near.collect()]
    assert len(got) == len(groups) and all(sum(x in got and x[0] == min(g, key=str and (lambda y: (y[0] is None, y[0] or 0)))[0] for x in g) == 1 for g in groups.values())
    mixed = saved(corpus_pipeline.mixing(spark, near, ""), "mixed")
    sizes, counts = defaultdict(int), defaultdict(int)
    for r in near.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    for r in mixed.collect():
        counts[r.doc_id, r.text] += 1
    assert mixed.columns == docs.columns and max(counts.values()) <= 2
    goals = brute_targets({k: v for k, v in sizes.items()})
    for source, goal in goals.items():
        words = [len(WORD.findall(r.text or "")) for r in mixed.where(mixed.source == source).collect()]
        assert abs(sum(words) - goal) <= max(words)
    packed = corpus_pipeline.pack(spark, mixed, "").collect()
    whole = sum(len(token_ids.encoder(tokenizer_path()).many([r.text or ""])[0]) // 4 + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == whole


def test_pipeline_stages(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = saved(stage(spark, first, d), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= first.count()
        assert kept.join(first, "doc_id", "left_anti").count() == 0
        if name == "exact_dedup":
            assert {r.doc_id for r in kept.collect()} == {r[0] for r in brute_dedup([(x.doc_id, x.text) for x in first.collect()]) if r[3]}
        if name == "jaccard_join":
            assert {r.doc_id for r in kept.collect()} == {i for i, _, c in brute_components([(x.doc_id, x.text) for x in first.collect()]) if i == c}
        first = kept
    mixed = saved(corpus_pipeline.mixing(spark, first, d), "mixing")
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 2").isEmpty()
    packed = corpus_pipeline.pack(spark, mixed, d)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    empty = docs.where("false")
    clash = docs.selectExpr("*", "'mine' as score", "1 as predicted", "2 as _id", "3 as key", "4 as node", "5 as taken")
    kept = clash
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = saved(stage(spark, kept, d), "clash")
        assert kept.columns == clash.columns and {(r.score, r.key) for r in kept.select("score", "key").collect()} == {("mine", 3)}
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, d)
        assert empty.count() == 0
        if empty.columns != docs.columns:
            break


def test_failed_pairs_return_to_the_groups_that_proposed_them(spark, monkeypatch):
    """One row a proposal, whatever the number of groups and of failed pairs of its nodes."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    rows = spark.createDataFrame([(s, n, n - 1) for s in range(30) for n in range(1, 6)], "sign long, node long, place long")
    hot = spark.createDataFrame([(s, 3) for s in range(30)], "sign long, blocks long")
    apart = spark.createDataFrame([(0, 1, n) for n in range(2, 6)] + [(7, 1, 3), (99, 1, 3)], "sign long, hub long, node long")
    got = sorted(map(tuple, jaccard_join._apart_in_cells(apart, rows, hot).collect()))
    assert got == [(0, 0, 1, 2), (0, 1, 1, 3), (0, 1, 1, 4), (0, 2, 1, 5), (7, 1, 1, 3)]


@pytest.mark.parametrize("sent", [0, 100])
def test_verification_reads_the_texts_that_pairs_name(spark, monkeypatch, sent):
    monkeypatch.setattr(jaccard_join, "SENT_IDS", sent)
    base = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[20:])), (4, "other words")], "doc_id long, text string")
    known = jaccard_join.nodes(docs).where("node is not null and n_shingles > 3").selectExpr("node", "doc_id AS rep")
    of = {r.rep: r.node for r in known.collect()}
    pairs = spark.createDataFrame([(of[1], of[2]), (of[1], of[3])], "hub long, node long")
    out = jaccard_join.verified(pairs, known, docs)
    assert {r.node: r.linked for r in out.collect()} == {of[2]: True, of[3]: False}
    assert ("LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()) == (sent > 0)
