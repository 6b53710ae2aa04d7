"""The ten operators against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from segloom.llm import common, compact_windows, embeddings, mixing, packing, quality_classifier, quality_rules, revisits, sharding, shared_keys, simhash, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, node long, component_id long, k long, slot int, mix_taken long, _spans string, n_removed long, n_words long, key string, bucket int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(n))


def nasty(seed=1, n=40):
    """(doc_id, text, source): random texts, copies, near copies, shared passages, nulls, empty, blank and long texts, all ids mixed."""
    rng = random.Random(seed)
    passage = prose(rng, 60, 10_000)
    texts = [prose(rng, rng.choice([1, 3, 30, 120, 300]), 5000) for _ in range(n)]
    texts += [texts[5], texts[5], texts[7] + " tail", " ".join(texts[8].split()[1:])]
    texts += [prose(rng, 40, 9000) + "\n" + passage + "\n" + prose(rng, 30, 9000) for _ in range(4)]
    texts += [None, "", " \n\t", "é" * 300, "ab" * 200, "the the the " * 80, prose(rng, 6000, 20_000), "\x00 \x1c a b 北京 " + passage]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sources = ["b", "a", None, "ä", "B"]
    return [(i, t, sources[k % 5]) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


@pytest.fixture(scope="module")
def rows():
    return nasty()


def frame(spark, rows, parts=3):
    full = [(i, t, None, s, None, 7, 0.5, 1, 2, 3, 4, 5, "x", 6, 7, "k", 8) for i, t, s in rows]
    return spark.createDataFrame(full, CLASH).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], CLASH)


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def words(text):
    return WORD.findall(text or "")


# 1


def test_classifier_learns_and_cuts_at_the_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality_classifier.FEATURES))
    good = x[:, 3] + 0.3 * rng.normal(size=400) > -0.8
    model = quality_classifier.fit(x, good, float((~good).mean()), 0.3)
    s = quality_classifier.apply(model, x)
    assert ((s >= 0.3) == good).mean() > 0.9 and 0 < s.min() and s.max() < 1
    assert abs((s < 0.3).mean() - (~good).mean()) < 0.03


def test_classifier_on_odd_tables(spark, rows):
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 3 and 1, 0) for i, _, _ in rows] + [(None, 1, 0), (3, None, None), (3, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.score(docs, quality_classifier.train(docs, labels))
    got = out.collect()
    assert out.columns.count("score") == 1 and len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    one = quality_classifier.train(docs, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in quality_classifier.score(docs, one, keep_text=False).collect()} == {round(1 / (1 + np.exp(-2.0)), 6)}
    none = quality_classifier.train(empty(spark), labels.limit(0))
    assert quality_classifier.score(empty(spark), none).count() == 0


# 2


def late_bytes(rows):
    seen, out = set(), {}
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        hit, own = np.zeros(len(raw) + 1, int), set()
        for p in range(len(raw) - 49):
            own.add(raw[p : p + 50])
            if raw[p : p + 50] in seen:
                hit[p] += 1
                hit[p + 50] -= 1
        seen |= own
        out[i] = (raw, np.cumsum(hit)[:-1] > 0)
    return out


def test_suffix_dedup_is_exact(spark, rows):
    docs = frame(spark, rows)
    out = suffix_dedup.remove(docs, common.cut(suffix_dedup.repeated(docs), "spans"))
    got = {r.doc_id: r for r in out.collect()}
    for i, (raw, late) in late_bytes(rows).items():
        left = bytes(np.frombuffer(raw, np.uint8)[~late])
        r = got[i]
        assert (r.n_bytes, r.n_removed, bytes(r.text), r.kept_sha256) == (len(raw), int(late.sum()), left, hashlib.sha256(left).hexdigest())
        assert r.n_spans == int((np.diff(np.concatenate([[0], late.astype(int)])) == 1).sum())
    assert suffix_dedup.repeated(empty(spark)).count() == 0
    twice = frame(spark, [r for r in rows if r[0] < 5] * 2 + [(None, "x" * 90, "a")])
    assert suffix_dedup.remove(twice, suffix_dedup.repeated(twice)).where("doc_id is null and n_removed = 0").count() == 1


def removed(docs):
    return {(r.doc_id, r.n_bytes): r for r in suffix_dedup.remove(docs, common.cut(suffix_dedup.repeated(docs), "spans")).collect()}


def test_suffix_dedup_of_hot_minimizers_and_periodic_texts(spark, monkeypatch):
    rng = random.Random(12)
    template = prose(rng, 14, 10_000)
    texts = [template[:60] + f" {rng.randrange(10**9)} {prose(rng, 6, 9000)}" for _ in range(60)]
    texts += ["-" * 3000, "-" * 700 + " end", "ab" * 900, "x" + "ab" * 300, "-" * 80 + "ab" * 80, "abc" * 400]
    rows = [(3 * i % 67, t, "a") for i, t in enumerate(texts)]
    want = late_bytes(rows)
    for hot in (2, 1000):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = removed(frame(spark, rows))
        for i, (raw, late) in want.items():
            assert bytes(got[i, len(raw)].text) == bytes(np.frombuffer(raw, np.uint8)[~late])


def test_strings_of_a_periodic_text_travel_once(spark):
    docs = spark.createDataFrame([(1, "ab" * 10_000), (2, "ab" * 10_000)], "doc_id long, text string").coalesce(1)
    shared = suffix_dedup.shared_keys(docs, suffix_dedup.keys_of, 4).groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    parts = suffix_dedup.candidates(shared_keys.squeezed_text(docs).join(shared, "doc_id").coalesce(1), 4, np.zeros(0, np.int64)).where("not known").collect()
    assert sum(len(shared_keys.expanded(r["data"])) for r in parts) < 1000


def test_rows_of_one_id_with_other_texts_are_judged_alone(spark):
    rng = random.Random(13)
    first, second = prose(rng, 30, 10_000), prose(rng, 40, 10_000)
    docs = frame(spark, [(1, first, "a"), (2, second, "a"), (2, first + " " + second, "a"), (3, "tail " + second, "b"), (3, "none of it", "b")])
    got = removed(docs)
    assert got[2, len(second)].n_removed == 0 and got[2, len(first + second) + 1].n_removed == len(first)
    assert got[3, len(second) + 5].n_removed >= len(second) and got[3, 10].n_removed == 0


def test_suffix_classes_are_equality_of_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[:400]
    data[2000:2100] = data[350:450]
    data[2050] ^= 1
    pos = np.arange(len(data) - 49)
    kind = suffix_dedup.suffix_classes(data, pos)
    seen = {}
    for p, k in zip(pos, kind, strict=True):
        assert seen.setdefault(bytes(data[p : p + 50]), k) == k
    assert len(set(kind)) == len(seen)


def test_runs_give_every_window_once_and_the_same_key_to_equal_ones():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 4000).astype(np.uint8)
    data[3000:3300] = data[100:400]
    at = np.array([0, 30, 30, 1500, 4000])
    keys = {}
    for row, key, first, last in suffix_dedup.runs(data, at):
        for r, k, a, z in zip(row, key, first, last, strict=True):
            for p in range(a, z + 1):
                assert p not in keys and at[r] <= p and p + 50 <= at[r + 1]
                keys[p] = k
    assert len(keys) == (1500 - 30 - 49) + (2500 - 49)
    assert all(keys[p] == keys[p + 2900] for p in range(100, 351))


# 3


def test_revisits_against_a_scan(spark):
    rng = random.Random(8)
    urls = ["http://A.com/x/", "http://a.com:80/x?utm_a=1", "https://b.org/?b=2&a=1#f", "https://b.org?a=1&b=2", None]
    records = []
    for i in range(300):
        kind = rng.choice(["response", "revisit"])
        records.append((i, rng.choice(urls), rng.randint(0, 60) if rng.random() > 0.05 else None, kind, rng.choice(["e1", "e2", None]), rng.choice(["m1", "m2", None]), {"etag": "n", "server": str(i), "date": str(i)} if rng.random() > 0.1 else None, "keep"))
    df = spark.createDataFrame(records, "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, outcome string").withColumn("outcome", F.lit(None).cast("string"))
    got = {r.record_id: r for r in revisits.resolve(df, span=7).collect()}
    canon = {urls[0]: "x", urls[1]: "x", urls[2]: "b", urls[3]: "b"}
    order = lambda r: (-(10**9) if r[2] is None else r[2], r[3] == "revisit", r[0])
    last = {}
    for r in sorted(records, key=order):
        if r[1] is None:
            want, found = ("response" if r[3] == "response" else "no_response"), None
        else:
            if r[3] == "response":
                last[canon[r[1]]] = r
            found = last.get(canon[r[1]])
            if r[3] == "response":
                want = "response"
            elif found is None:
                want = "no_response"
            elif r[4] and found[4]:
                want = "resolved" if r[4] == found[4] else "mismatch"
            elif r[5] and found[5]:
                want = "resolved" if r[5] == found[5] else "mismatch"
            else:
                want = "no_validator"
        assert got[r[0]].outcome == want, r
        assert got[r[0]].response_id == (found[0] if found else None)
        if want == "resolved":
            headers = dict(found[6] or {})
            headers.update({k: v for k, v in (r[6] or {}).items() if k in revisits.PERMITTED})
            assert got[r[0]].merged_headers == headers
        else:
            assert got[r[0]].merged_headers is None
    assert revisits.resolve(df.limit(0)).count() == 0


# 4


def test_tiles_find_the_links_of_double_precision(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 24))
    x = np.concatenate([base, base[:10] + 0.28 * rng.normal(size=(10, 24)), base[:10] * 3, -base[:3], base[:4]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [[], None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows += [(100 + i, v) for i, v in enumerate(odd)] + [(None, base[0].tolist())]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    comp = components(range(len(x)), zip(*np.nonzero(near), strict=True))
    for i in range(1, len(x)):
        extra = 1 if near[0][i] else 0  # the row without an id is a copy of row 0
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum() + extra, comp[i], comp[i] == i)
    assert [got[100 + i].n_links for i in range(8)] == [0] * 6 + [1, 1] and got[107].component_id == 106
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = embeddings.quantise(x)
    every = np.arange(len(x))
    for y, e in ((v.s[:, None] * v.q, v.e), (v.doubles(every), v.f)):
        assert (np.linalg.norm(x - y, axis=1) <= e).all()
        assert (abs(y @ y.T - x @ x.T) <= e[:, None] + e + e[:, None] * e + 1e-12).all()
    assert v.f.max() < v.e.max() / 100


def test_tiles_in_many_sides_settle_pairs_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "SIDE", 16 * 2 * 16)
    monkeypatch.setattr(embeddings, "WIDE", 7)
    monkeypatch.setattr(embeddings, "STRIPE", 5)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(40, 16))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = 0.9 + np.repeat([1e-9, -1e-9, 1e-5, -1e-5], 10)
    x = np.concatenate([base, cosine[:, None] * base + np.sqrt(1 - cosine**2)[:, None] * side])
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect()}
    near = x @ x.T / np.linalg.norm(x, axis=1) / np.linalg.norm(x, axis=1)[:, None] >= 0.9
    np.fill_diagonal(near, False)
    comp = components(range(len(x)), zip(*np.nonzero(near), strict=True))
    assert near.sum() >= 40
    assert all((got[i].n_links, got[i].component_id) == (near[i].sum(), comp[i]) for i in range(len(x)))


# 5


def plain_print(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_all_pairs(spark, rows):
    rows = [*rows, (900, "A b C d E", "a"), (901, "a B c D e", "a")]
    prints = {i: plain_print(t) for i, t, _ in rows}
    comp = components(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4])
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in got} == {i: (prints[i], comp[i]) for i in prints}
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_masks_cover_the_radius():
    rng = random.Random(0)
    found = [m % 2**64 for m in simhash.masks(4)]
    assert len(found) == 31
    for _ in range(2000):
        flip = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flip & m for m in found)


def test_links_in_hot_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = list({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(80)})
    rows = [(p - 2**64 if p >> 63 else p, i) for i, p in enumerate(prints)]
    edges = simhash.links(spark.createDataFrame(rows, "fp long, node long")).collect()
    assert all((prints[e.src] ^ prints[e.dst]).bit_count() <= 64 for e in edges)
    got = components(range(len(prints)), [(e.src, e.dst) for e in edges])
    want = components(range(len(prints)), [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert got == want


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    ids = list(range(200))
    rng.shuffle(ids)
    edges = list(zip(ids, ids[1:], strict=False)) + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**dict.fromkeys(range(200), 0), 1000: 1000, 1001: 1000}
    assert common.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_similar_documents(spark, rows):
    rng = random.Random(4)
    near = []
    for k in range(30):
        w = prose(rng, 150, 8000).split()
        near.append((2000 + 2 * k, " ".join(w), "a"))
        w[rng.randrange(150)] = "changed"
        near.append((2001 + 2 * k, " ".join(w), "a"))
    rows = [*rows, *near]
    sets = {i: shingles(t) for i, t, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(frame(spark, rows)).collect()}
    assert got == want
    assert simhash.similar_documents(empty(spark)).count() == 0


def similar_by_brute_force(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    return components(sets, [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])


def test_similar_documents_with_new_words(spark):
    rng = random.Random(12)
    rows = []
    for k in range(100):
        n = (100, 30, 300, 12)[k % 4]
        w, new = prose(rng, n, 8000).split(), [f"new{k}x{i}" for i in range(n // 6)]
        edit = [w + new, new + w, w[: n // 2] + new + w[n // 2 :], ["first", *w[1:-1], "last"], w[: -len(new)]][k % 5]
        rows += [(2 * k, " ".join(w), "a"), (2 * k + 1, " ".join(edit), "a")]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(frame(spark, rows)).collect()}
    assert got == similar_by_brute_force(rows)


def test_similar_documents_are_not_hidden_by_a_smaller_one(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SIDE", 5)
    rng = random.Random(13)
    rows = []
    for k in range(12):  # all versions of a text meet under the keys of the first, which is too far from most of them
        w = prose(rng, 120, 9000).split()
        for i in range(12):
            rows.append((20 * k + i, " ".join(w), "a"))
            for _ in range(rng.choice([1, 2, 6])):
                w[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(frame(spark, rows)).collect()}
    assert got == similar_by_brute_force(rows)


# 6


def test_compact_windows_are_the_definition():
    rng = np.random.default_rng(7)
    token = rng.integers(0, 2**63, 600, dtype=np.uint64)
    token[300:360] = token[40:100]
    at = np.array([0, 20, 250, 600])
    part, key, left, mid, right = compact_windows.compact_windows(token, at, 1)
    v = (token ^ compact_windows.ODD[7]) * compact_windows.ODD[8]
    v ^= v >> np.uint64(29)
    v *= compact_windows.ODD[1]
    v ^= v >> np.uint64(32)
    rank = (v & ~np.uint64(2**24 - 1)) | np.arange(600, dtype=np.uint64)
    want = set()
    for a, z in zip(at, at[1:], strict=False):
        for i in range(a, z):
            lo, hi = i, i
            while lo > a and rank[lo - 1] > rank[i]:
                lo -= 1
            while hi < z - 1 and rank[hi + 1] > rank[i]:
                hi += 1
            if hi - lo + 1 >= compact_windows.TOKENS:
                want.add((lo, i, hi))
    assert set(zip(left.tolist(), mid.tolist(), right.tolist(), strict=True)) == want
    assert (v[mid].view(np.int64) == key).all() and (np.searchsorted(at, mid, "right") - 1 == part).all()


def test_passages_are_removed_and_clean_texts_kept(spark, rows):
    out = compact_windows.deduplicate(frame(spark, rows))
    got = {r.doc_id: r for r in out.collect()}
    text = {i: t for i, t, _ in rows}
    seen = set()
    for i in sorted(text):
        w = (text[i] or "").encode().lower().split()
        runs = {tuple(w[p : p + 50]) for p in range(len(w) - 49)}
        r = got[i]
        if runs & seen:
            assert r.n_removed >= 50 and r.sources and max(r.sources) < i
        assert len((r.text or "").encode().split()) == r.n_words - r.n_removed
        if not r.n_removed:
            assert r.text == text[i]
        else:
            left = r.text.encode().lower().split()
            assert not {tuple(left[p : p + 50]) for p in range(len(left) - 49)} & seen
        seen |= runs
    assert sum(r.n_removed > 0 for r in got.values()) <= 12
    assert compact_windows.deduplicate(empty(spark)).count() == 0


def test_verified_accepts_edits_and_rejects_strangers():
    rng = np.random.default_rng(1)
    other = rng.integers(0, 2**32, 200).astype(np.uint32)
    mine = other[50:120].copy()
    mine[30] ^= 1
    assert compact_windows.verified(mine, 0, 70, other) == [(0, 70)]
    assert compact_windows.verified(rng.integers(0, 2**32, 100).astype(np.uint32), 0, 100, other) == []
    assert compact_windows.verified(mine[:40], 0, 40, other) == []
    assert compact_windows.verified(mine, 0, 70, other[:0]) == []


def test_verified_aligns_repeats_and_insertions():
    words = lambda r, n: r.integers(0, 2**63, n, dtype=np.uint64)
    low = lambda w: compact_windows.tokens(w).astype(np.uint32)
    rng = np.random.default_rng(2)
    passage = words(rng, 60)
    edited = passage.copy()
    edited[30] += np.uint64(1)
    other = np.concatenate([words(rng, 50), passage[10:15], words(rng, 40), passage, words(rng, 20)])
    (got,) = {(a, b) for a, b in compact_windows.verified(low(edited), 0, 56, low(other))}
    assert got == (0, 56)
    whole = words(rng, 120)
    mine = whole.copy()
    mine[[30, 90]] += np.uint64(1)
    other = np.concatenate([whole[:60], words(rng, 40), whole[60:]])
    got = compact_windows.verified(low(mine), 0, 116, low(other))
    assert {x for a, b in got for x in range(a, b)} >= {*range(56), *range(60, 116)}


def test_shared_keys_and_stars(spark):
    rng = random.Random(9)
    have = {i: {rng.randint(0, 300) for _ in range(8)} for i in range(60)}
    mixed = lambda k: (k * 0x9E3779B97F4A7C15) % 2**63

    def keys_of(column):
        got = [(r, mixed(int(k))) for r, t in enumerate(column.to_pylist()) for k in t.split()]
        return np.array([g[0] for g in got], int), np.array([g[1] for g in got], np.int64)

    df = spark.createDataFrame([(i, " ".join(map(str, sorted(ks)))) for i, ks in have.items()], "doc_id long, text string").repartition(3)
    count = Counter(k for ks in have.values() for k in ks)
    got = {}
    for r in shared_keys.shared_keys(df, keys_of, 5).collect():
        got.setdefault(r.doc_id, set()).update(shared_keys.unplanes(r["keys"], shared_keys.BITS // 8).tolist())
    assert got == {i: w for i, ks in have.items() if (w := {mixed(k) % 2**shared_keys.BITS for k in ks if count[k] > 1})}
    most = max(count.values())
    hot = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in shared_keys.shared_keys(df, keys_of, 5, most).where("doc_id is null").collect()])
    assert set(hot.tolist()) == set(shared_keys.hot_code(np.array([mixed(k) for k in count if count[k] == most]), 5).tolist())


# 7


def keyed(spark, texts):
    df = frame(spark, texts).select("doc_id", "text", sharding.text_key("doc_id", "text").alias("k"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.lit(1).alias("slot"), F.lit("x").alias("start"))
    return common.cut(df, "k")


@pytest.mark.parametrize(("copies", "cells"), [(150, 4), (1000, 1), (3000, 7)])
def test_shards_are_level_and_gapless_and_keep_equal_texts(spark, rows, copies, cells):
    texts = [(i, t, s) for i, t, s in rows] + [(5000 + i, "same text", "a") for i in range(copies)] + [(9000, "t", "a")] * 2
    df = keyed(spark, texts)
    out = sharding.shard(df, cells=cells).collect()
    assert len(out) == len(texts) and {r.start for r in out} == {"x"}
    sizes, slots, where, groups = Counter(), {}, {}, Counter()
    for r in out:
        sizes[r.shard] += r.size
        groups[r.text or ""] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.text or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert set(sizes) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    heavy = {where[t].copy().pop() for t, n in groups.items() if n > sum(sizes.values()) / 8}
    light = {s: n for s, n in sizes.items() if s not in heavy}
    largest = max(n for t, n in groups.items() if not where[t] & heavy)
    assert not light or max(light.values()) <= sum(light.values()) / (8 - len(heavy)) + largest


def test_shards_of_odd_tables(spark, rows):
    df = keyed(spark, rows)
    assert sharding.shard(df.limit(0)).count() == 0
    assert [r.slot for r in sharding.shard(df.limit(1)).collect()] == [0]
    nothing = sharding.shard(df.withColumn("size", F.lit(None).cast("long")), cells=2).collect()
    assert len(nothing) == len(rows)
    alike = sharding.shard(keyed(spark, [(i, "one text", "a") for i in range(500)]), cells=5).collect()
    assert len({r.shard for r in alike}) == 1 and sorted(r.slot for r in alike) == list(range(500))


def test_splitters_bracket_their_goals(spark):
    rng = random.Random(4)
    keys = sorted([rng.randrange(1 << 63) for _ in range(300)] + [5 << 30] * 100)
    df = spark.createDataFrame([(k, 1) for k in keys], "k long, size long").cache()
    goals = [20 * i for i in range(1, 20)]
    for a, x, b, y in sharding.splitters(df, goals, 0):
        assert (x, y) == (sum(k < a for k in keys), sum(k < b for k in keys))
    assert all(x <= g <= y for (_, x, _, y), g in zip(sharding.splitters(df, goals, 0), goals, strict=True))


# 8


def shares(sizes, weights):
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i for i, w in enumerate(weights) if i not in capped and left * w > 3 * sizes[i] * weight}
        if not over:
            return [3 * s if i in capped else left * w / weight for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
        capped |= over


def test_targets(spark):
    rng = random.Random(3)
    for case in range(6):
        sizes = {f"s{k}" if k else None: rng.choice([0, 1, 5, 40, 1000, 10**12]) * rng.randint(1, 3) for k in range(rng.randint(1, 9))}
        names = sorted((n for n in sizes if n), key=lambda n: n.encode()) + [n for n in sizes if n is None]
        weights = [(5, 2, 1)[i % 3] for i in range(len(names))]
        rows = spark.createDataFrame([(n, sizes[n], 10) for n in names], "mix_name string, mix_source_size long, mix_n long")
        got = {r.mix_name: r for r in mixing.targets(rows, (5, 2, 1), 3).collect()}
        want = shares([sizes[n] for n in names], weights)
        for n, w in zip(names, want, strict=True):
            r = got[n]
            assert r.mix_target == pytest.approx(w) and (not sizes[n] or 0 <= r.mix_rest < sizes[n] and abs(r.mix_epochs * sizes[n] + r.mix_rest - w) < 1 + 1e-12 * w)


def test_mix_joins_many_sources_by_an_exchange(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"s{i % 40}", i % 7) for i in range(400)], "doc_id long, source string, size long")
    few = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 5)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == few


def test_mix_takes_each_budget_exactly(spark, rows):
    docs = frame(spark, [*rows, *rows[:3]])
    out = mixing.mix(mixing.sized(docs)).collect()
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
        assert r["size"] == len(words(r.text)) and 0 <= r.mix_taken <= 3 * r["size"]
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    want = shares([sum(r["size"] for r in by[s]) for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, target in zip(names, want, strict=True):
        assert all(r.mix_target == pytest.approx(target) for r in by[s])
        assert sum(r.mix_taken for r in by[s]) == int(target + 1e-6)
    again = mixing.mix(mixing.sized(docs.repartition(2))).collect()
    assert Counter((r.doc_id, r.mix_taken) for r in out) == Counter((r.doc_id, r.mix_taken) for r in again)
    assert mixing.mix(mixing.sized(empty(spark))).count() == 0


# 9


def test_text_stats(spark, rows):
    got = {r.doc_id: r for r in quality_rules.text_stats(frame(spark, rows)).collect()}
    for i, t, _ in rows:
        w = words(t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        many = Counter(grams)
        covered = {k + d for k, g in enumerate(grams) if many[g] > 1 for d in range(5)}
        lines, seen, dup = [x for x in (t or "").split("\n") if WORD.search(x)], set(), 0
        for x in lines:
            dup += x in seen
            seen.add(x)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered))


def naive_em(votes, rounds):
    """fit_votes document by document, with plain numbers."""
    m = len(votes[0])
    prior = [[(quality_rules.GOOD, quality_rules.TRUST)] * m] + [[(quality_rules.OWN, quality_rules.TRUST) if i == j else (quality_rules.OTHER, 2.0) for i in range(m)] for j in range(m)]
    share, p = [0.85] + [0.15 / m] * m, [[x for x, _ in row] for row in prior]

    def posterior(v):
        like = [share[c] * np.prod([{0: p[c][i], 1: 1.0, 2: 1 - p[c][i]}[x] for i, x in enumerate(v)]) for c in range(m + 1)]
        return [x / sum(like) for x in like]

    for _ in range(rounds):
        part = [posterior(v) for v in votes]
        p = [[(sum(w[c] for w, v in zip(part, votes, strict=True) if v[i] == 0) + prior[c][i][0] * prior[c][i][1]) / (sum(w[c] for w, v in zip(part, votes, strict=True) if v[i] != 1) + prior[c][i][1]) for i in range(m)] for c in range(m + 1)]
        share = [(sum(w[c] for w in part) + 1) / (len(votes) + m + 1) for c in range(m + 1)]
    return [posterior(v)[0] for v in votes], p


def test_em_against_a_naive_one():
    rng = np.random.default_rng(3)
    votes = rng.choice(3, size=(300, 4), p=[0.15, 0.25, 0.6])
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, p = quality_rules.fit_votes(patterns, counts.astype(float), rounds=25)
    good, q = naive_em(votes.tolist(), 25)
    assert np.allclose(p, q) and np.allclose(quality_rules.responsibilities(patterns, share, p)[0][back.ravel()], good)


@pytest.mark.parametrize("copies", [1, 100])
def test_em_estimates_accuracies_that_differ_from_its_start(copies):
    rng = np.random.default_rng(2)
    n, m = 100_000, 9
    bad = rng.random(n) < 0.2
    reject = rng.random((n, m)) < np.where(bad[:, None], 0.4, 0.05)
    votes = np.where(rng.random((n, m)) < 0.2, 1, np.where(reject, 0, 2))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, p = quality_rules.fit_votes(patterns, counts * float(copies))
    found = quality_rules.accuracies(share, p)
    assert abs(found[:, 0] - 0.05).max() < 0.05 and abs(found[:, 1] - 0.4).max() < 0.05 and abs(share[0] - 0.8) < 0.05


def test_em_finds_faults_that_come_alone():
    rng = np.random.default_rng(2)
    n, m = 20_000, 5
    bad = rng.random(n) < 0.15
    kind = rng.integers(0, m, n)
    votes = rng.choice(3, size=(n, m), p=[0.003, 0.2, 0.797])
    own = bad & (rng.random(n) < 0.9)
    votes[own, kind[own]] = 0
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    for copies in (1, 1000):
        share, p = quality_rules.fit_votes(patterns, counts * float(copies))
        good = quality_rules.responsibilities(patterns, share, p)[0][back.ravel()]
        assert ((good < 0.5) == bad).mean() > 0.95 and abs(share[0] - 0.85) < 0.05


def test_kept_is_the_verdict_of_a_naive_em(spark, rows):
    got = quality_rules.judge(common.cut(quality_rules.text_stats(frame(spark, rows)).withColumns({f"vote_{k}": v for k, v in quality_rules.votes().items()}), "s")).collect()
    good, _ = naive_em([[r[f"vote_{k}"] for k in quality_rules.votes()] for r in got], 1000)
    assert all(abs(r.posterior - g) < 1e-3 and r.kept == (not r.base_failed and r.posterior >= 0.5) for r, g in zip(got, good, strict=True))


def test_rules_on_odd_tables(spark, rows):
    out = quality_rules.judge(common.cut(quality_rules.text_stats(frame(spark, rows)), "s"))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    assert all(r.base_failed == (r.n_words < 10 or 5 * r.n_repeat_words > r.n_words) and not (r.kept and r.base_failed) for r in got.values())
    assert quality_rules.judge(quality_rules.text_stats(empty(spark))).count() == 0


# 10


def test_column_generation_is_near_the_bound():
    rng = random.Random(6)
    for _ in range(20):
        counts = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(rng.randint(1, 20))}
        plan = packing.plan(counts, 64)
        have = Counter()
        for sizes, k in plan:
            assert sum(sizes) <= 64
            for s in sizes:
                have[s] += k
        assert have == counts
        room = []
        for s in sorted(counts, reverse=True):  # first fit decreasing
            for _ in range(counts[s]):
                i = next((i for i, r in enumerate(room) if r >= s), None)
                if i is None:
                    room.append(64)
                    i = -1
                room[i] -= s
        assert sum(k for _, k in plan) <= len(room) + len(counts)
    assert packing.plan({}, 64) == []


def test_pieces_and_sequences_round_trip(spark, rows):
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.vocabulary()
    plain = tokenizers.Tokenizer.from_file(path)
    rows = [*rows, (700, "Don't, I'll ΑΣ ας. İ x's ... !!! á ½ ﬁ ,a .b", "a"), *rows[:2]]
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t, _ in rows}
    out = packing.pack(common.cut(packing.pieces(frame(spark, rows), path), "pieces")).collect()
    copies = Counter(i for i, _, _ in rows)
    assert Counter((r.doc_id, r.start) for r in out) == Counter({(i, a): c for i, c in copies.items() for a in range(0, len(ids[i]), 4096)})
    sequences = {}
    for r in out:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.pack(packing.pieces(empty(spark), path)).count() == 0


def test_encoder_forgets_without_harm(monkeypatch):
    pytest.importorskip("tokenizers")
    monkeypatch.setattr(packing, "WORDS", 5)
    of = packing.Encoder(packing.vocabulary())
    texts = pa.array([f"alpha{i}, beta gamma{i % 3}." for i in range(40)] + [None, ""])
    for _ in range(2):
        ids, at = of.texts(texts)
        for t, a, z in zip(texts.to_pylist(), at[:-1], at[1:], strict=True):
            assert ids[a:z].tolist() == of.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_growing_tables_are_never_broadcast(spark):
    from pyspark.sql import functions as F

    from segloom.llm.simhash import near_duplicates, similar_documents

    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 60]) for i in range(0, 300, 5)] + [" ".join([*words[i : i + 60], "more"]) for i in range(0, 300, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1")  # a broadcast of anything fails
    try:
        assert near_duplicates(docs).agg(F.count("*")).first()[0] == 120
        found = {r.doc_id: r.component_id for r in similar_documents(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert all(found[i] == found[i + 60] for i in range(60))


def test_windows_beyond_two_to_the_24_places():
    token = np.random.default_rng(8).integers(0, 2**63, 2**24 + 6000, dtype=np.uint64)
    at = np.array([*range(0, 2**24, 2**20), 2**24 - 3000, 2**24 + 3000, len(token)])
    part, *found = compact_windows.compact_windows(token, at, 2)
    for i in (0, 7, len(at) - 3, len(at) - 2):
        _, key, *places = compact_windows.compact_windows(token[at[i] : at[i + 1]], np.array([0, at[i + 1] - at[i]]), 2)
        own = part == i
        assert np.array_equal(found[0][own], key)
        for x, y in zip(found[1:], places, strict=True):
            assert np.array_equal(x[own], y + at[i])


def test_texts_with_any_number_of_matches_are_compared(monkeypatch):
    rng = np.random.default_rng(12)
    fresh = lambda n: rng.integers(0, 2**32, n).astype(np.uint32)
    line, passage = fresh(10), fresh(60)
    edited = passage.copy()
    edited[[25, 40]] ^= 1
    mine = np.concatenate([np.tile(line, 800), edited])
    other = np.concatenate([np.tile(line, 1500), fresh(20_000), passage, fresh(50)])
    assert sum(int((other == t).sum()) for t in line) * 800 > compact_windows.MATCHES
    got = {x for a, b in compact_windows.verified(mine, 0, len(mine), other) for x in range(a, b)}
    assert got == set(range(8060))
    # All runs of TOKENS by brute force; what else is found is similar as a whole.
    monkeypatch.setattr(compact_windows, "MATCHES", 0)
    size = compact_windows.TOKENS
    for seed, runs in ((0, 256), (1, 16), (2, 16), (3, 16)):
        monkeypatch.setattr(compact_windows, "RUNS", runs)
        monkeypatch.setattr(compact_windows, "FAR_RUNS", 2 * runs)
        some = np.random.default_rng(seed)
        mine, other = (some.integers(0, (9000, 60, 25, 400)[seed], n) for n in (260, 300))
        mine[50:130] = other[100:180]
        mine[50 + some.integers(0, 80, 3)] += 1
        mine = np.concatenate([mine, np.tile(line, 12)])
        other = np.concatenate([np.tile(line, 9 * (seed % 2)), other])
        far = [set(other[c : c + size].tolist()) for c in range(len(other) - size + 1)]
        want = set()
        for a in range(len(mine) - size + 1):
            own = set(mine[a : a + size].tolist())
            if any(len(own & x) >= 0.8 * len(own | x) for x in far):
                want |= set(range(a, a + size))
        got = {x for a, b in compact_windows.aligned(mine, other) for x in range(a, b)}
        assert len(want) > 40 and got >= want and len(got) <= len(want) + 10


def test_copies_are_known_before_the_comparison(spark):
    rng = random.Random(4)
    one, two, short = prose(rng, 80, 10**6), prose(rng, 70, 10**6), "a short text"
    rows = [(3, one), (7, one), (9, one), (9, two), (5, two + " tail"), (4, short), (8, short), (6, None), (10, None), (7, one)]
    docs = frame(spark, [(i, t, "s") for i, t in rows])
    with_text = docs.where("text is not null").select("doc_id", "text")
    found = compact_windows.whole_copies(with_text)
    assert {(r.doc_id, r.rep, r.lo) for r in found.collect()} == {(7, 3, 0), (8, 4, 0)}
    got = {(r.doc_id, r.n_words): (r.n_removed, list(r.sources)) for r in compact_windows.deduplicate(docs).collect()}
    assert got[3, 80] == (0, []) and got[7, 80] == (80, [3]) and got[9, 80][0] == 80 and got[9, 70][0] == 70
    assert got[4, 3] == got[8, 3] == (0, []) and got[6, 0] == got[10, 0] == (0, [])
    assert compact_windows.near_passages(with_text).where("doc_id = 7").first().spans[0].hi == compact_windows.END  # not compared


def test_known_tokens_are_not_compared_again(monkeypatch):
    """What is found beside the known tokens is the same, and runs that failed are not tried again."""
    rng = np.random.default_rng(12)
    tried, whole = [], compact_windows.similar
    monkeypatch.setattr(compact_windows, "similar", lambda x, y: tried.append((x.tobytes(), y.tobytes())) or whole(x, y))
    seen = lambda got: {x for a, b in got for x in range(a, b)}
    counts = {False: 0, True: 0}
    for _ in range(30):
        line = rng.integers(0, 400, 60)
        other = np.concatenate([line, rng.integers(0, 400, 40), line[::-1], rng.integers(0, 400, 200)])
        mine = np.concatenate([other[100:160], rng.integers(0, 400, 30), line, other[180:300]])
        edit = rng.integers(0, len(mine), 25)
        mine[edit] = rng.integers(0, 400, 25)
        known = np.zeros(len(mine), bool)
        known[:150] = True
        for f in (compact_windows.aligned, lambda x, y, *k: compact_windows.verified(x.astype(np.uint32), 0, len(x), y.astype(np.uint32), *k)):
            tried.clear()
            full = seen(f(mine, other))
            counts[False] += len(tried)
            assert len(set(tried)) == len(tried) or f is not compact_windows.aligned
            tried.clear()
            some = seen(f(mine, other, known))
            counts[True] += len(tried)
            assert full >= some and full | {*range(150)} == some | {*range(150)}
    assert 0 < counts[True] < counts[False]


def test_keys_need_no_trees_and_documents_no_broadcast(spark, monkeypatch):
    rng = random.Random(13)
    text = pa.array([prose(rng, 300, 10**6).encode() for _ in range(5)])
    full = [(w.row, w.key) for w, _, _ in compact_windows.windows_of(text)]
    monkeypatch.setattr(compact_windows, "_tree", None)
    row, key = compact_windows.keys_of(text)
    assert np.array_equal(row, np.concatenate([x for x, _ in full])) and np.array_equal(key, np.concatenate([x for _, x in full]))
    monkeypatch.undo()
    out = compact_windows.deduplicate(frame(spark, [(i, prose(rng, 80, 10**6), "s") for i in range(4)]))
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().toString()


def test_hot_tokens_are_counted_in_parts(monkeypatch):
    """The documents of all rare tokens of a long document are never in memory at once."""
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 2**32, 600).astype(np.uint32)
    empty, planes = b"", shared_keys.planes
    row = lambda i: {"node": i, "lo": planes(np.array([0]), 8), "size": planes(np.array([600]), 8), "token": rng.permutation(shared).tobytes(), "key": empty, "function": empty, "left": empty, "mid": empty, "right": empty}
    docs = [compact_windows._Document(row(i)) for i in range(60)]
    sizes, whole = [], np.bincount
    monkeypatch.setattr(compact_windows, "AT_ONCE", 600)
    monkeypatch.setattr(np, "bincount", lambda x, **k: sizes.append(len(x)) or whole(x, **k))
    assert list(compact_windows.class_passages(docs, np.zeros(60, int), False)) == []
    assert sizes and max(sizes) <= 600 + 60
