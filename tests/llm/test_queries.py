"""Every query of the folder over whole tables: against its SQL, or against a plain version in Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import compare
import corpus_pipeline
from tidemark.llm import catalog, crf, decontaminate, maxent, mixing, pii, shards, simhash, toxicity, warc, wavelet

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


def answer(spark, name):
    return catalog.queries()[name](spark, SMALL)


@pytest.mark.parametrize("name", sorted(catalog.sql_answers()))
def test_against_sql(spark, con, name):
    df, sql = answer(spark, name), catalog.sql_answers()[name]
    assert compare.type_gaps(df, con, sql) == {}
    assert compare.spark_answer(df) == compare.sql_answer(con, sql)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_plan_multiplies_rows_or_gathers_a_table(spark, name):
    """One task may only receive what was reduced before; in op4 and op8 also the list of files, a row for each."""
    plan = answer(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.split("\n")
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "partial_" in lines[at + 1] or "-manifest-" in "".join(lines[at + 1 : at + 7])


@pytest.mark.parametrize("name", ["op2_poisson_mix", "op12_license_diagonals"])
def test_native_queries_run_no_python(spark, name):
    plan = answer(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.queries()) == list(range(1, 14))


def test_op1_shards(spark, docs):
    rows = answer(spark, "op1_sampled_splitters").collect()
    texts = dict(docs)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        plain = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(plain) + 16, zlib.crc32(plain), "bytes", None)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op1_sizes_are_near_equal_and_hot_texts_are_cut(spark):
    rows = [(i, f"text {i} " * (1 + i % 40)) for i in range(20_000)] + [(20_000 + i, "the same text " * 10) for i in range(12_000)]
    found = shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8)
    sizes = [r[1] for r in found.groupBy("shard").sum("size").collect()]
    assert len(sizes) == 8 and max(sizes) < 1.05 * min(sizes)
    spread = found.filter("text not like 'the same%'").groupBy("text").agg({"shard": "max"}).count()
    assert spread == 20_000


@pytest.mark.parametrize("drawn", [[], [5], [5] * 100, list(range(100)), [2**63 - 1] * 50, [-(2**63)] * 50 + [7]])
def test_boundaries_cover_all_keys(drawn):
    bounds = shards.boundaries(np.sort(np.array(drawn, np.int64)), 8)
    assert (np.diff(bounds) > 0).all()
    found = shards.Splitters(bounds, np.full(len(bounds) + 1, 3), 3 * np.arange(len(bounds) + 1))
    keys = np.array([-(2**63), -1, 0, 5, 6, 99, 2**63 - 1], np.int64)
    pieces = found.pieces(keys, keys[::-1].copy())
    assert (np.diff(found.ranges(keys)) >= 0).all() and (pieces // 3 == found.ranges(keys)).all()


def test_op2_rates_reach_the_target(spark):
    rows = [(i, "big" if i % 3 else "small") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "mix_source string, weight double")
    counts = dict(map(tuple, mixing.mix(docs, wanted=mixing.rates(docs, weights=weights, total=40_000)).groupBy("source").count().collect()))
    assert abs(counts["small"] - 30_000) < 700 and abs(counts["big"] - 10_000) < 400


def test_op2_large_rates(spark):
    docs = spark.createDataFrame([(i, "one") for i in range(20)], "doc_id long, source string")
    counts = mixing.mix(docs, wanted=mixing.rates(docs, total=20 * 3_000)).select("doc_id", "n_copies").distinct().collect()
    assert len(counts) == 20 and all(abs(r.n_copies - 3_000) < 330 for r in counts)


def test_op4_files(spark, docs):
    coder = Tokenizer.from_file(public_tokenizers.path(wavelet.TOKENIZER))
    rows = {r.doc_id: r for r in answer(spark, "op4_wavelet_tokens").collect()}
    start = 0
    for doc_id, text in sorted(docs):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


ODD_TEXTS = [
    "", "İstanbul ΑΣ ΑΣΑ éa x", "it's We'LL 'd''re a<|endoftext|>b <|startoftext|>", "ＡＢ １２ ½ x²y Ǆ", "a\x1cb\x85c\xa0d",
    "don'tx 'sx 's's ß×÷ À", "😀😀a𝒳", "a\x00b\x7f", "́a", "x ́a Ångstrom", "日本語 テキスト", "''s'm 12'34 a1b2",
]


def test_op4_words_alone_are_coded_as_in_whole_texts(docs):
    path = public_tokenizers.path(wavelet.TOKENIZER)
    coder, mine = Tokenizer.from_file(path), wavelet.Encoder(path)
    for text in [t for _, t in docs] + ODD_TEXTS:
        assert np.frombuffer(mine.encode(text), np.uint16).tolist() == coder.encode(text or "", add_special_tokens=False).ids


def test_op4_known_words_are_not_cut_again(monkeypatch):
    mine = wavelet.Encoder(public_tokenizers.path(wavelet.TOKENIZER))
    first = mine.encode("Don't stop\tit's 12 o'clock\n" + "x" * 100)
    monkeypatch.setattr(wavelet, "_PIECES", None)
    assert mine.encode("don't STOP it's 12 o'clock") == first[: len(mine.encode("Don't stop it's 12 o'clock"))]
    assert max(map(len, mine.simple)) <= wavelet._LONGEST


@pytest.mark.parametrize("size,symbols", [(0, 1), (1, 1), (513, 1), (2_000, 2), (5_000, 300)])
def test_op4_rank_select_access(size, symbols):
    ids = np.random.default_rng(size).integers(0, symbols, size).astype(np.uint16) * 7
    data = wavelet.packed(wavelet.WaveletMatrix.build(ids), np.array([3]), np.array([1], np.uint8), np.array([size]))
    matrix, doc_ids, _, ends = wavelet.unpacked(data)
    assert (matrix.decode() == ids).all() and doc_ids.tolist() == [3] and ends.tolist() == [size]
    for at in range(0, size, 97):
        assert matrix.access(at) == ids[at]
    for s in sorted(set(ids.tolist()))[:20] + [1]:
        places = np.flatnonzero(ids == s)
        assert matrix.rank(s) == len(places) and matrix.rank(s, size // 2) == (places < size // 2).sum()
        assert [matrix.select(s, k) for k in range(min(len(places), 5))] == places[:5].tolist()
        assert matrix.select(s, len(places)) == -1
        ends = np.arange(0, size + 1, 3)
        assert (matrix.ranks(s, ends) == np.searchsorted(places, ends)).all()
        assert np.concatenate([*matrix.positions(s), np.zeros(0, int)]).tolist() == places.tolist()
    for damaged in (data[:-1], data + b"x", data[:40] + bytes([data[40] ^ 1]) + data[41:], b"other"):
        with pytest.raises(ValueError):
            wavelet.unpacked(damaged)


def test_op4_counts_and_occurrences(spark, docs, monkeypatch, tmp_path):
    monkeypatch.setattr(wavelet, "_PART", 100)
    path = public_tokenizers.path(wavelet.TOKENIZER)
    coder, places, marks, start = Tokenizer.from_file(path), {}, {}, 0
    for doc_id, text in sorted(docs):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        for position, t in enumerate(ids):
            places.setdefault(t, []).append((t, doc_id, start, position))
        marks[doc_id] = ids.count(1)
        start += len(ids)
    often = sorted(places, key=lambda t: -len(places[t]))
    asked, absent = [1, often[0], often[100], often[-1]], max(places) + 1
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    manifest = wavelet.write(given, str(tmp_path / "files"), path, shard_tokens=5_000)
    assert manifest.count() > 4
    assert {r.doc_id: r.n_marks for r in wavelet.read(manifest).collect()} == marks
    counts = sorted(map(tuple, wavelet.counts(manifest, [*asked, absent, None, 1]).collect()))
    assert counts == sorted([*((t, len(places[t])) for t in set(asked)), (absent, 0)])
    found = sorted(map(tuple, wavelet.occurrences(manifest, [*asked, absent, None, 1]).collect()))
    assert found == sorted(p for t in set(asked) for p in places[t])
    none = wavelet.write(given.limit(0), str(tmp_path / "none"), path)
    assert wavelet.counts(none, [5]).collect() == [(5, 0)] and wavelet.occurrences(none, [5]).count() == 0
    assert wavelet.counts(manifest, []).count() == 0 and wavelet.occurrences(manifest, []).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Least id reachable, by comparing all pairs."""
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    distinct = sorted(prints)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for p, ids in prints.items():
        least[root(p)] = min([*ids, *([least[root(p)]] if root(p) in least else [])])
    return {p: least[root(p)] for p in prints}


def test_op5_groups(spark, docs):
    prints = defaultdict(list)
    for doc_id, text in docs:
        prints[plain_fingerprint(text)].append(doc_id)
    least = plain_components(prints)
    expected = sorted((i, f"{p:016x}", least[p]) for p, ids in prints.items() for i in ids)
    assert sorted(map(tuple, answer(spark, "op5_simhash_groups").collect())) == expected


def test_op5_links_are_all_pairs_within_two_bits(spark):
    draw = np.random.default_rng(5)
    values = {0, (1 << 64) - 1}
    for _ in range(40):
        p = int(draw.integers(0, 1 << 63)) * 2 + int(draw.integers(0, 2))
        values.add(p)
        for flips in (1, 2, 2, 2, 3, 3):
            for _ in range(3):
                values.add(p ^ sum(1 << int(b) for b in draw.choice(64, flips, replace=False)))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in sorted(values)]
    found = [tuple(r) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()]
    all_ = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert len(found) == len(set(found)) and set(found) == all_


def test_op5_long_chains_are_one_component(spark):
    from tidemark.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(1_000, 1_001), (1_001, 1_000), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(1, 201)}, 1_001: 1_000}


def test_op6_automaton_against_windows():
    draw = np.random.default_rng(6)
    text = lambda n: " ".join(draw.choice(["a", "b", "c"], n))
    for window in (3, 5):
        items = [(str(i), text(int(n)).encode().split()) for i, n in enumerate(draw.integers(0, 12, 12))]
        machine = decontaminate.Automaton(items, window)
        for _ in range(60):
            words = (text(int(draw.integers(0, 40))) + " x " + text(10)).encode().split()
            hit, met = set(), set()
            for name, item in items:
                k = min(window, len(item))
                for i in range(len(item) - k + 1 if k else 0):
                    for j in range(len(words) - k + 1):
                        if words[j : j + k] == item[i : i + k]:
                            met.add(name)
                            hit.update(range(j, j + k))
            spans, found = machine.scan(words)
            assert found == met and {p for s, e in spans for p in range(s, e)} == hit
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_op6_cut_spans():
    text = "Keep this, One two-three FOUR! and that."
    assert decontaminate.cut_spans(text, [{"start": 2, "end": 6}], 3) == "Keep this, ! and that."
    assert decontaminate.cut_spans(text, [{"start": 2, "end": 6}], 5) == text


def test_op7_held_out_accuracy(spark):
    name = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{name}/labels.parquet'").fetchall())
    rows = toxicity.op7_toxic_spans(spark, name).collect()
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.predicted == toxic[r.doc_id] for r in held) > 0.97 * len(held)


def test_op7_marginals_against_all_paths():
    draw = np.random.default_rng(7)
    model = crf.Field(np.zeros(crf.BUCKETS), 0.0, draw.normal(size=(2, 2)), float(draw.normal()))
    lengths = np.array([1, 3, 7, 2])
    scores = draw.normal(size=int(lengths.sum())) * 3
    got, at = model.marginals(scores, lengths), 0
    for n in lengths:
        weight = np.zeros((n, 2))
        for path in range(1 << n):
            tags = [path >> k & 1 for k in range(n)]
            total = model.start * tags[0] + sum(s * t for s, t in zip(scores[at : at + n], tags))
            total += sum(model.moves[a, b] for a, b in zip(tags, tags[1:]))
            for k, t in enumerate(tags):
                weight[k, t] += math.exp(total)
        assert np.allclose(got[at : at + n], weight[:, 1] / weight.sum(axis=1))
        at += n


def test_op7_marginals_of_long_texts_do_not_depend_on_blocks():
    model = crf.Field(np.zeros(crf.BUCKETS), 0.0, np.array([[-0.01, -5.0], [-1.0, -0.4]]), -4.0)
    scores = np.random.default_rng(8).normal(size=1_000) * 4
    whole = model.marginals(np.concatenate((scores, scores)), np.array([1_000, 1_000]))
    assert np.allclose(whole[:1_000], whole[1_000:]) and np.allclose(whole[:1_000], model.marginals(scores, np.array([1_000])))


def test_op8_archives(tmp_path):
    payload = b"<html>one</html>"
    digest = "A" * 32
    import base64
    import io

    import zstandard

    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    record = warc.record(7, "http://a/b", digest, payload, len(payload), None)
    assert warc.parsed(record)["payload"] == payload
    for wrong in (record[:-1], record.replace(b"one", b"two"), record.replace(b"WARC/1.1", b"WAR/1.1"), record.replace(b"response\r\nWARC-Record", b"other\r\nWARC-Record")):
        with pytest.raises((ValueError, KeyError)):
            warc.parsed(wrong)
    held = zstandard.ZstdCompressionDict(record)
    frames = [zstandard.ZstdCompressor(dict_data=held, write_checksum=True).compress(record) for _ in range(5)]
    data = warc.opening(held.as_bytes()) + b"".join(frames)
    for chunk in (1, 7, 1 << 16):
        assert list(warc.frames(io.BytesIO(data), chunk)) == [record] * 5
    for wrong in (data[:-3], data[:5], b"".join(frames)):
        with pytest.raises(ValueError):
            list(warc.frames(io.BytesIO(wrong)))


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(found)]


def test_op9_base(spark, docs):
    rows = {r.doc_id: r for r in answer(spark, "op9_bootstrapped_pii").collect()}
    for doc_id, text in docs:
        base, r = plain_base(text or ""), rows[doc_id]
        listed = [f"{k}:{s}:{e}" for s, k, e in base]
        counts = Counter(k for _, k, _ in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in pii.KINDS[:4]]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}


def test_op9_base_on_random_texts():
    draw = np.random.default_rng(9)
    for _ in range(20_000):
        text = "".join(draw.choice(list("01 .@-a+()٣%"), int(draw.integers(0, 40))))
        assert pii.base_spans(text) == plain_base(text)


def test_op9_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [(i, f'before key = "{hashlib.md5(str(i).encode()).hexdigest()}" after') for i in range(30)]
    unseen = [(100, 'other key = "0123456789abcde9" end'), (101, "the number 1234567890123456 alone"), (102, "nothing")]
    docs = spark.createDataFrame(seeds + unseen, "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert all([s.kind for s in rows[i].added] == ["secret"] for i, _ in seeds)
    assert [(s.start, s.end, s.kind) for s in rows[100].added] == [(13, 29, "secret")]
    assert rows[101].added == [] and rows[102].added == []


CARDS = [f"{s[:4]}{sep}{s[4:]}" for s in ("4111111111111111", "5500005555555559", "340000000000009", "30000000000004") for sep in ("", " ", "-")]
FINDS = {
    "email": ("please write to", [f"name{i}@mail.example.org" for i in range(12)], "annameier(at)example(dot)org"),
    "ip": ("the host is", [f"10.20.{i}.{i + 7}" for i in range(12)], "fe80:1:2:3:4:5:6:7"),
    "card": ("charge my card:", CARDS, "4111 1111 1111 1112"),
    "phone": ("call me at", [f"+1 (212) 555-01{i:02d}" for i in range(12)], "(212) 555-0199"),
}


@pytest.mark.parametrize("kind", FINDS)
@pytest.mark.parametrize("other", ["", "annameier", "nothing"])
def test_op9_each_kind_of_context_finds_unseen_words(spark, kind, other):
    """Letters alone are found where they stand nowhere else; a word of the language in the same place is not."""
    context, seeds, unseen = FINDS[kind]
    unseen = other or unseen
    texts = [*[f"Some text, {context} {w} today" for w in [*seeds, unseen]], *CARDS[:6], "there is nothing of note", "but nothing, nothing here", "another text"]
    found = {r.doc_id: r.added for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    at = len(f"Some text, {context} ")
    assert [tuple(s) for s in found.pop(len(seeds))] == ([] if other == "nothing" else [(at, at + len(unseen), kind)])
    assert not any(found.values())


def test_op9_found_words_lead_to_further_contexts(spark):
    numbers = [f"(212) 555-01{i}" for i in range(10, 16)]
    texts = [*[f"call me at +1 (212) 555-02{i}" for i in range(10, 70)], *[f"call me at {n}" for n in numbers], *[f"my desk line {n}" for n in numbers], "call us"]
    found = {r.doc_id: r.added for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {i for i, spans in found.items() if spans} == set(range(60, 72))


def chained(hops):
    """Contexts that a few unseen words keep from being trusted, until those words are known from the context before."""
    known = [f"+1 (212) 555-02{i}" for i in range(10, 70)]
    new = [[f"(3{hop:02d}) 555-01{i}" for i in range(10, 16)] for hop in range(hops + 1)]
    texts = []
    for hop in range(hops):
        words = [*known, *(new[hop] if hop else []), *new[hop + 1]]
        texts += [f"desk{chr(97 + hop)} line {w}" for w in words]
    return texts


def plain_bootstrap(texts):
    """`(text, start, end, kind)` by the same rules over plain sets: every pattern and every word is looked at whole."""
    base = [pii.base_spans(t) for t in texts]
    words = [(i, s, e, pii._pattern(t, s, e), t[s:e]) for i, t in enumerate(texts) for s, e, _ in pii.free_words(t, base[i])]
    seeds = {row for t, b in zip(texts, base) for row in pii.seeds(t, b)}
    known_pairs, scores = {(p, w) for _, p, w in seeds}, {(w, kind): 1.0 for kind, _, w in seeds}
    inside, patterns_of = defaultdict(set), defaultdict(set)
    for *_, p, w in words:
        inside[p].add(w)
        patterns_of[w].add(p)
    for p, w in known_pairs:
        inside[p].add(w)
    trusted, last = {}, Counter()
    while True:
        rated = {w for w, _ in scores}
        support = Counter(p for p, w in known_pairs if w in rated)
        wanted = {p for p, n in support.items() if n >= pii.SUPPORT and n > last[p] and p not in {q for q, _ in trusted}}
        last = Counter({p: n for p, n in support.items() if n >= pii.SUPPORT})
        new = {}
        for p in wanted:
            for kind in pii.KINDS:
                hits = sum(scores.get((w, kind), 0.0) for w in inside[p])
                if hits >= pii.SUPPORT and hits / len(inside[p]) >= pii.CONFIDENCE:
                    new[p, kind] = hits / len(inside[p])
        trusted |= new
        places = {(i, s, e, w, p, kind): trusted[p, kind] for i, s, e, p, w in words for kind in pii.KINDS if (p, kind) in trusted}
        by_word = {}
        for (*_, w, p, kind), confidence in places.items():
            if (w, kind) not in scores:
                by_word.setdefault((w, kind), {})[p] = confidence
        if not new or not by_word:
            break
        for (w, kind), patterns in by_word.items():
            others = {(p, w) for p in patterns_of[w]}
            score = max(patterns.values()) * (len(patterns) / len(others) if pii.plain(w) else 1.0)
            known_pairs |= others
            if score >= pii.LEAST:
                scores[w, kind] = score
    best = {}
    for (i, s, e, w, p, kind), confidence in places.items():
        if (w, kind) in scores:
            best[i, s, e] = max(best.get((i, s, e), (0, "")), (confidence, kind))
    return {(*place, kind) for place, (_, kind) in best.items()}


def added(spark, texts, **how):
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **how).collect()
    return {(r.doc_id, *s) for r in rows for s in r.added}


def test_op9_rounds_go_to_the_fixed_point(spark):
    texts = chained(5)
    found = added(spark, texts)
    assert {texts[i][s:e] for i, s, e, _ in found} == {w.split(" ", 2)[2] for w in texts if "+" not in w}
    assert found == plain_bootstrap(texts)
    assert len(added(spark, texts, rounds=2)) < len(found)


def test_op9_against_a_plain_bootstrap(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    found = added(spark, texts)
    assert found and found == plain_bootstrap(texts)


def test_op9_removes_its_steps(spark):
    from tidemark.session import shared_dir

    folder = Path(shared_dir(spark)) / "tidemark"
    before = set(folder.glob("pii-*"))
    found = pii.find(spark.createDataFrame(list(enumerate(chained(2))), "doc_id long, text string"))
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("pii-*")) - before} == {"pii-read", "pii-spans"}
    assert found.count() == len(chained(2))


@pytest.mark.parametrize("head", [0, 50, maxent.HEAD])
def test_op10_base(spark, docs, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    rows = answer(spark, "op10_hashed_maxent").collect()
    assert sorted(r.doc_id for r in rows) == sorted(words)
    for r in rows:
        ws = words[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in counts for w in ws), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    if head:
        assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_op10_third_word_before_counts():
    n = maxent.CLASSES * maxent.MEMBERS
    assert n >= 1024
    known = maxent.Vocabulary({}, np.zeros(0, np.int64), np.zeros(0), 0, 0, np.zeros(maxent.CLASSES + maxent.RARE, np.float32), np.zeros((maxent.CLASSES, maxent.MEMBERS), np.float32), np.zeros(maxent.RARE))
    weights = maxent.Weights(*(np.random.default_rng(1).normal(size=t.shape).astype(np.float32) for t in vars(maxent.Weights.zero()).values()))
    last = [maxent.log_chances(np.array([third, 2, 3, 4]), np.array([0]), known, weights)[-1] for third in (7, 700)]
    assert last[0] != last[1]


def test_op10_rows_grow_with_the_corpus():
    sizes = [maxent.table_rows(n) for n in (0, 10**6, 10**8, 10**9, 10**12)]
    assert sizes[:2] == [maxent.ROWS] * 2 and sizes[1] < sizes[2] < sizes[3] <= sizes[4] == maxent.MOST_ROWS
    assert all(n & (n - 1) == 0 for n in sizes)
    pairs = np.arange(maxent.CLASSES * maxent.MEMBERS)
    held = [len(np.unique(maxent._class_rows(n, pairs, pairs[::-1], pairs)[1])) for n in sizes[1:4]]
    assert held[0] < held[1] < held[2]


def test_op10_updates_touch_the_rows_of_the_batch():
    draw = np.random.default_rng(2)
    rows, gradient = draw.integers(0, 1 << 14, (4, 300)), draw.normal(size=(300, 5)).astype(np.float32)
    start = draw.normal(size=(1 << 14, 5)).astype(np.float32)
    table, squares = start.copy(), np.zeros(1 << 14, np.float32)
    maxent._updated(table, squares, rows, gradient)
    summed = np.zeros(table.shape)
    for r in rows:
        np.add.at(summed, r, gradient)
    past = (summed**2).mean(axis=1)
    assert np.allclose(squares, past, rtol=1e-4)
    assert np.allclose(table, start - maxent.RATE * summed / np.sqrt(past + 1)[:, None], rtol=1e-4, atol=1e-5)
    assert (squares[np.setdiff1d(np.arange(1 << 14), rows)] == 0).all()


def test_op10_chances_sum_to_one(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    counts = {bytes(r[0]): r[1] for r in maxent.word_counts(frame, "text").collect()}
    known = maxent.vocabulary(maxent.word_counts(frame, "text"))
    weights = maxent.Weights(*(np.random.default_rng(1).normal(size=t.shape).astype(np.float32) for t in vars(maxent.Weights.zero()).values()))
    words = [*list(counts), *(b"?" + bytes([65 + i]) for i in range(26))]
    history = [b"the", b"of"]
    total, unseen = 0.0, set()
    for w in words:
        symbols, _ = known.symbols([*history, w])
        log = maxent.log_chances(symbols, np.array([0]), known, weights)[-1]
        if symbols[-1] >= maxent.CLASSES * maxent.MEMBERS:
            rare = int(symbols[-1]) - maxent.CLASSES * maxent.MEMBERS
            if w not in counts:
                if rare in unseen:
                    continue
                unseen.add(rare)
            log += math.log10(counts.get(w, 0) + 1) - known.rare_total[rare]
        total += 10**log
    for rare in set(range(maxent.RARE)) - unseen:
        symbols = np.array([*known.symbols(history)[0], maxent.CLASSES * maxent.MEMBERS + rare])
        total += 10 ** (maxent.log_chances(symbols, np.array([0]), known, weights)[-1] - known.rare_total[rare])
    assert math.isclose(total, 1.0, rel_tol=1e-3)


def test_pipeline(spark, con, docs):
    """Each stage against a plain version on what its predecessor kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {"documents": {r.doc_id: r.text for r in frame.collect()}}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SMALL)
        if name != "sharding":
            assert out.dtypes == frame.dtypes
        from tidemark.llm.common import settled

        frame = settled(out, "test-stage")
        kept[name] = frame.select("doc_id", "text").collect()
    scores = {r.doc_id: r.score for r in answer(spark, "op7_toxic_spans").collect()}
    toxic_free = {i: t for i, t in kept["documents"].items() if scores[i] < 0.5}
    assert {r.doc_id: r.text for r in kept["toxicity"]} == toxic_free
    prints = defaultdict(list)
    for i, t in toxic_free.items():
        prints[plain_fingerprint(t)].append(i)
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted(set(plain_components(prints).values()))
    bad = {r[0] for r in con.execute(catalog.sql_answers()["op6_benchmark_contamination"]).fetchall() if r[-1]}
    assert sorted(r.doc_id for r in kept["decontamination"]) == sorted(r.doc_id for r in kept["near_dedup"] if r.doc_id not in bad)
    ids = [r.doc_id for r in kept["decontamination"]]
    con.execute("CREATE OR REPLACE TEMP TABLE left_over AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [ids])
    mixed = con.execute(f"WITH {mixing.MIX_VIEWS.format(documents='left_over')} SELECT doc_id FROM mixed").fetchall()
    assert Counter(r.doc_id for r in kept["mixing"]) == Counter(i for i, in mixed)
    assert Counter(r.doc_id for r in kept["sharding"]) == Counter(r.doc_id for r in kept["mixing"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "text").collect())) == sorted((r.doc_id, r.text) for r in kept["sharding"])
