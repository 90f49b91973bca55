"""The training-data operators against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rentrisk.llm import ann, langid, minhash, mixing, packing, pii, quality, queries, records, suffixes, tokens, urlfilter
from rentrisk.session import materialize, scratch_path
from tests.conftest import SF001, SF01
from tests.oracle_check import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, "a b c a b c"), (2, None), (3, ""), (4, " \n\t "), (5, "é" * 300), (5, "é" * 300), (6, "x " * 3000),
        (None, "no key at all"), (7, "a b c a b c"), (8, "9" * 20000)]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows and extra columns with clashing names."""
    docs = spark.createDataFrame([(k, t, "en" if k else None, "s", 1) for k, t in EDGE],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("key", "kind", "v", "label", "size", "_n", "row", "n", "a", "b", "token"):
        docs = docs.withColumn(c, F.lit(1))
    return docs


@pytest.fixture(scope="session")
def empty(edge):
    return edge.filter("doc_id < 0")


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(spark, SF01, name, queries.QUERIES[name], queries.ORACLES[name]) > 0


def test_url_filter(spark):
    urls = [None, "", "x", "http://", "HTTP://A.Example.COM/en/x?y#z", "https://www.example.com/en/", "http://com/",
            "http://example.com/de/", "http://b.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://example.com",
            "http://h.com/" + "a/" * 2000, "http://b.net/es/1"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in urlfilter.filter_urls(pages, urlfilter.rules_frame(spark, urlfilter.RULES)).collect()}
    rules = {4: "example.com/en/", 5: "www.example.com/en/", 6: "com/", 7: "com/", 8: "net/es/", 9: "net/fr/", 12: "com/", 13: "net/es/"}
    assert {k: r.rule for k, r in got.items() if r.rule} == rules and len(got) == len(urls)
    assert (got[4].host, got[4].path, got[4].verdict) == ("a.example.com", "/en/x", "block")
    assert got[0].host == got[2].path == "" and got[10].verdict == "allow"
    none = urlfilter.filter_urls(pages, urlfilter.rules_frame(spark, []))
    assert none.filter("rule is not null").count() == 0 and none.count() == len(urls)


def test_neighbours_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    ids, v = np.array([k for k, _ in rows]), np.array([x for _, x in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    found = defaultdict(list)
    for r in queries.op2_ann(spark, SF01).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in ids[ids % 50 == 0]:
        cos = v @ v[ids == q][0]
        cos[ids == q] = -2
        best = set(ids[np.argsort(-cos)[:5]])
        hits += len(best & {k for k, _ in found[q]})
        assert all(abs(s - cos[ids == k][0]) < 1e-9 for k, s in found[q])
    assert hits >= 0.9 * 5 * len(found) and len(found) == (ids % 50 == 0).sum()


def test_neighbours_edge(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (None, [1.0, 0.0])]
    good = [(k, [1.0, 0.0]) for k in range(50, 60)] + [(60, [0.0, 1.0])]
    rows = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>").withColumn("id", F.lit(0))
    got = ann.nearest(rows, rows.filter("vec_id in (1, 50, 60)")).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == [51, 52, 53, 54, 55, 50, 51, 52, 53, 54]
    assert ann.nearest(rows.limit(0), rows.limit(0)).count() == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _passes(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def _base(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if _passes(k, m.group())] for k, p in PLAIN.items()}


def test_pii_brute_force(spark):
    made = ["mail a@b.c.%x@d.e x@y.zz 1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.4 4111 1111 1111 1111 +1 (988) 555-2485 é",
            "4111-1111-1111-1111 4111111111111112 +12 34 +1((((5 1.1.1.1", "é@x.y a@b a@b.c@d.e", "", None, "1 " * 4000]
    docs = docs_of(spark, SF01).select("doc_id", "text").union(
        spark.createDataFrame([(-i, t) for i, t in enumerate(made, 1)], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for k, t in pairs_of(docs):
        for kind, spans in _base(t).items():
            assert [(x["s"], x["e"]) for x in got[k][kind]] == spans, (k, kind)


def test_pii_mask_and_edge(spark, edge, empty):
    d = spark.createDataFrame([(1, "call 212-555-1212 or a@b.cd, GB82 WEST 1234 5698 7654 32."), (2, "plain 212-555-1212"), (3, None)],
                              "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.mask(d).collect()}
    assert out == {1: "call <LOCAL> or <EMAIL>, <IBAN>.", 2: "plain 212-555-1212", 3: None}
    assert pii.mask(edge).columns == edge.columns and pii.find(edge).count() == len(EDGE) and pii.find(empty).count() == 0


def test_pii_added_kinds_in_running_text(spark):
    es, gb = "ES91 2100 0418 4502 0005 1332", "GB82 WEST 1234 5698 7654 32"
    cases = {f"{es} Banco": {es}, f"{es.replace(' ', '')} Banco": {es.replace(" ", "")}, f"{es} BIC CAIXESBB": {es},
             f"{es} {gb}": {es, gb}, f"Ref AB12 3456 7890 {gb}.": {gb}, f"{gb} BIC": {gb}, f"{es.replace('1332', '1333')} BIC": set(),
             "NO93 8601 1117 947 og": {"NO93 8601 1117 947"}, "LC14BOSL123456789012345678901234": {"LC14BOSL123456789012345678901234"},
             "Call 212-555-1212.": {"212-555-1212"}, "call 212-555-1212.5": set(),
             "Call 212-555-1212 or 212-555-1313, (212) 555-1414.": {"212-555-1212", "212-555-1313", "(212) 555-1414"},
             "212-555-1212 is the phone": {"212-555-1212"}, "call é" + "x" * 45 + " 212-555-1212": set(),
             "call " + "212-555-1212 " * 3 + "x" * 40 + " 212-555-1212": {"212-555-1212"}}
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in pii.find(rows).join(rows, "doc_id").collect():
        assert {r.text[x["s"]:x["e"]] for k in ("iban", "local") for x in r[k]} == cases[r.text], r.text
    last = next(r for r in pii.find(rows).collect() if r.doc_id == len(cases) - 1)
    assert len(last["local"]) == 3


def test_language(spark, edge, empty):
    docs = docs_of(spark, SF01)
    got = queries.op4_language_id(spark, SF01).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held if r["lang"]]) > 0.95
    model = langid.train(docs)
    out = langid.predict(edge, model).collect()
    assert len(out) == len(EDGE) and sum(r.lang_pred == "und" and r.score == 0 for r in out) == 4
    assert langid.train(empty).names == [] and langid.predict(empty, model).count() == 0


def test_language_sample_holds_every_language(spark):
    words = {"aa": "the cat and dog", "bb": "le chat et chien", "cc": "die katze und hund"}
    rows = [(10 * i + j, f"{t} {i}", k) for i in range(1, 20) for j, (k, t) in enumerate(words.items()) for _ in range(1 if j else 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, settings=langid.Settings(per_language=10))
    assert model.names == ["aa", "bb", "cc"]
    probe = spark.createDataFrame(list(enumerate(words.values())), "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(probe, model).collect()} == dict(enumerate(words))


def test_quality_edge(edge, empty):
    got = [r for r in quality.judge(edge).collect()]
    assert len(got) == len(EDGE) and not any(r.kept for r in got)
    assert {r.n_repeat_words for r in got if r.doc_id in (1, 7)} == {6} and quality.keep_good(edge).columns == edge.columns
    assert quality.judge(empty).count() == 0


def test_mixing(spark, edge, empty):
    rows = queries.op6_mixing(spark, SF01).collect()
    size = Counter()
    taken, target = Counter(), {}
    for d in docs_of(spark, SF01).collect():
        size[d["source"]] += len(WORD.findall(d["text"] or ""))
    by_doc = {d["doc_id"]: d for d in docs_of(spark, SF01).collect()}
    for r in rows:
        d = by_doc[r["doc_id"]]
        assert r["size"] == len(WORD.findall(d["text"] or "")) and r["source_size"] == size[d["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[d["source"]] += r["taken"]
        target[d["source"]] = r["target"]
    assert len(rows) == len(by_doc) and abs(sum(target.values()) - sum(size.values())) < 1e-3
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op6_mixing(spark, SF01).collect()))
    again = mixing.Mix(docs_of(spark, SF01).repartition(7, "n_chars")).taken().withColumnRenamed("key", "doc_id").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    small = mixing.Mix(edge).taken().collect()
    assert len(small) == len(EDGE) and all(r.taken == 0 for r in small if r.size == 0)
    assert mixing.Mix(empty).taken().count() == 0
    mixed = mixing.apply(edge)
    assert mixed.columns == edge.columns
    words = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in small)


def test_mixing_parts():
    assert mixing.targets([10, 100, 0], [5, 2, 1]) == pytest.approx([30.0, 80.0, 0.0])
    for n in (1, 2, 7, 100):
        p = mixing.Permutation(n, 1, 0, 3)
        assert sorted(p(np.arange(n))) == list(range(n)) and p.place_of(int(p(n // 2)[0])) == n // 2
    drawn = mixing.draw_shards([5, 0, 17], 4, 1)
    assert Counter({s: sum(c for _, t, _, c in drawn if t == s) for s in (0, 2)}) == {0: 5, 2: 17}


def test_language_draw_is_bounded_and_many_languages_learn(spark):
    rows = [(70 * i + c, f"l{c:02d}", f"{chr(97 + c % 26)}{chr(97 + c // 3)}o{chr(97 + c % 26)} " * 20) for c in range(70) for i in range(8)]
    copies = [(100_000, "l00", "aaoa " * 20)] * 500
    schema = "doc_id long, lang string, text string"
    model = langid.train(spark.createDataFrame(rows + copies, schema), settings=langid.Settings(rows=560, epochs=60))
    assert len(model.names) == 70
    got = langid.predict(spark.createDataFrame(rows, schema), model).collect()
    right = {k: lang for k, lang, _ in rows}
    assert np.mean([r.lang_pred == right[r.doc_id] for r in got]) > 0.9


def _plain_probabilities(model, text):
    """A text's score by counting its n-grams one by one."""
    plain = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode())
    total, n = np.zeros(len(model.names)), 0
    for k in langid.ORDERS:
        for i in range(len(plain) - k + 1):
            code = int.from_bytes(plain[i:i + k], "little") + (k << 40)
            total += model.table[(code * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 51].astype(np.float64)
            n += 1
    z = (total / max(n, 1) + model.bias) / model.temperature
    z = np.exp(z - z.max())
    return z / z.sum()


def test_language_scores_brute_force(spark):
    docs = docs_of(spark, SF001)
    model = langid.train(docs.filter(~langid.in_fold("doc_id")))
    texts = [t or "" for _, t in pairs_of(docs.orderBy("doc_id").limit(40))] + ["a", "é", "ab", "Ab C", "x1y2", "ß" * 500, "a\n\nb"]
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.predict(probe, model).collect():
        p = _plain_probabilities(model, texts[r.doc_id])
        assert abs(r.score - p.max()) < 1e-5 and r.lang_pred == model.names[int(p.argmax())], r.doc_id


@cache
def _library():
    """The library as the contract names it, apart from the operator's own."""
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(text):
    return np.array([*_library().encode(text or "", add_special_tokens=False).ids, tokens.END], "<u4")


def test_encoder_is_the_library():
    texts = ["a  b", "  x \n\n y ", "it's we'll 12 34", "　全角 x  y", "<|endoftext|> a", "a <|endoftext|> b", "a b<|endoftext|>",
             "<|endoftext|", "ascii\x00b c\x7fd", "a\x1c b\x85 c", " ", "", "x\t y  ", "é è  ê " * 50]
    for t, got in zip(texts, tokens.encode_batches(texts)):
        assert got == _ids(t).tobytes(), t


def test_records(spark, edge, empty):
    got = {r["doc_id"]: r for r in queries.op7_token_records(spark, SF001).collect()}
    at = 0
    for k, t in sorted(pairs_of(docs_of(spark, SF001))):
        ids = _ids(t)
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    path = scratch_path(spark, "records")
    records.write_records(edge, path)
    back = [(r["key"], bytes(r["ids"])) for r in records.read_records(spark, path).collect()]
    assert sorted(back, key=str) == sorted([(k, _ids(t).tobytes()) for k, t in EDGE], key=str)
    one = spark.read.parquet(f"{path}/index").filter("key = 7").select("shard", "place")
    assert [bytes(r["ids"]) for r in records.fetch(spark, path, one).collect()] == [_ids("a b c a b c").tobytes()]
    frame = records.frame(b"body") + b"\n"
    with pytest.raises(ValueError):
        records.unframe(frame[:9] + b"X" + frame[10:], 0)
    path = scratch_path(spark, "records")
    records.write_records(empty, path)
    assert spark.read.parquet(f"{path}/index").count() == 0


def test_records_keep_order_when_sorts_spill(spark):
    docs = spark.range(6000).select((F.col("id") * 7 % 6000).alias("doc_id"), F.concat(F.lit("a b "), "id").alias("text"))
    conf, name = spark._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    path = scratch_path(spark, "records")
    conf.set(name, "100")
    try:
        records.write_records(docs, path)
    finally:
        conf.remove(name)
    keys = [r["key"] for r in spark.read.parquet(f"{path}/index").orderBy("shard", "place").collect()]
    assert keys == list(range(6000))


def _components(rows, width, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, inverse = {}, defaultdict(list)
    for k, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[k] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        for g in sets[k]:
            inverse[g].append(k)
    parent = {k: k for k in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, s in sets.items():
        for j, n in Counter(j for g in s for j in inverse[g] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_near_duplicates(spark):
    """Copies of one text with more and more words replaced: chains, outliers and a dense group."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(w if rng.random() > i % 20 / 100 else f"x{i}_{j}" for j, w in enumerate(base))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=width).collect()}
        assert got == _components(rows, width, 80)


def test_near_duplicates_edge(edge, empty):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(edge, width=2).collect()
                 if r.doc_id)
    want = {1: (3, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (0, 4, True), 5: (1, 5, True), 6: (1, 6, True), 7: (3, 1, False),
            8: (1, 8, True)}
    assert got == sorted((k, *want[k]) for k, _ in EDGE if k) and minhash.near_duplicates(empty).count() == 0
    assert minhash.keep_one(edge, width=2).count() == len(EDGE) - 1 and minhash.keep_one(edge).columns == edge.columns


def test_packing(spark, edge, empty):
    docs = dict(pairs_of(docs_of(spark, SF001)))
    rows = queries.op9_packing(spark, SF001).collect()
    full = Counter()
    spots = defaultdict(list)
    for r in rows:
        ids = _ids(docs[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 1024
        full[r["doc_id"]] += r["length"]
        spots[r["sequence_id"]].append((r["offset"], r["length"]))
    assert full == {k: len(_ids(t)) for k, t in docs.items()}
    for s in spots.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(s[-1]) <= 1024
    assert len(spots) <= -(-sum(full.values()) // 1024) + 3
    assert packing.pack_documents(edge, with_ids=True).groupBy("key").count().count() == len({k for k, _ in EDGE})
    assert packing.pack_documents(empty).count() == 0


def test_bins_fill_best():
    assert packing.fullest({5: 1, 4: 2, 3: 1}, 8) in ([5, 3], [4, 4])
    packed = packing.bins({6: 3, 5: 2, 4: 3, 1: 2}, 10)
    used = Counter()
    for lengths, times in packed:
        assert sum(lengths) <= 10
        used.update({k: n * times for k, n in Counter(lengths).items()})
    assert used == {6: 3, 5: 2, 4: 3, 1: 2} and sum(t for _, t in packed) == 5


def _repeats(rows, length):
    seen, out = set(), {}
    for k, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[k] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats(spark):
    rng = np.random.default_rng(2)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    passage, other = word(260), word(130)
    rows = [(i, word(int(rng.integers(0, 400))) + (passage if i % 3 else other)[i % 7:] + word(i % 50)) for i in range(80)]
    rows += [(100, "ab" * 400), (101, "ab" * 70), (102, passage), (103, passage + passage), (104, "x" * 99), (105, "x" * 101), (106, "é" * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:5]) for r in suffixes.remove_repeats(docs).collect()}
    assert got == _repeats(rows, 100)
    table = pairs_of(docs_of(spark, SF001))
    got = {r[0]: tuple(r[1:5]) for r in queries.op10_suffix_dedup(spark, SF001).collect()}
    assert got == _repeats(table, 100)


def test_windows_of_one_name_are_dealt_over_tasks(spark, monkeypatch):
    """A clause with different text around it in every document: its windows differ and share their anchor name."""
    rng = np.random.default_rng(4)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    clause, sizes, plain = word(60), [], suffixes.first_only

    def seen(*args):
        out = plain(*args)
        sizes.append([r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()])
        return out

    monkeypatch.setattr(suffixes, "first_only", seen)
    docs = spark.createDataFrame([(i, word(70) + clause + word(70)) for i in range(300)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert suffixes.remove_repeats(docs).agg(F.sum("n_removed")).first()[0] == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 2 and max(sizes[1]) < sum(sizes[1]) / 4


def test_repeats_edge(spark, edge, empty):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(edge).collect())
    want = _repeats([(k, t) for k, t in {(k or -1, t) for k, t in EDGE}], 100)
    assert got == sorted((str(k), *want[k or -1][:2]) for k, _ in EDGE) and suffixes.remove_repeats(empty).count() == 0


def test_repeats_in_long_texts(spark, monkeypatch):
    """A text over many pieces gives the same as in one."""
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 123, 5000, dtype=np.uint8)
    raw[3000:3700] = raw[100:800]
    data, offsets = raw, np.array([0, 5000])
    whole = list(suffixes.pieces(offsets, 100))
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(suffixes, "row_chunks", lambda o: iter([(0, 1)]))
    parts = list(suffixes.pieces(offsets, 100))
    names = lambda ps: {(n, s + a + k) for _, _, a, z in ps for n, _, _, s, e in zip(*suffixes.anchored(
        data[a:z], np.clip(offsets, a, z) - a, 100)) for k in range(e - s - 99)}
    assert len(parts) == 5 and names(parts) == names(whole) and len(names(whole)) == 4901


def test_pipeline(spark):
    """Each stage on what the stage before it kept, against brute force."""
    docs = docs_of(spark, SF001)
    columns = docs.columns
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001), "test")
        out.append(docs)
    good, single, masked, mixed, packed = out
    assert all(d.columns == columns for d in out[:-1])
    kept = {r.doc_id for r in quality.judge(docs_of(spark, SF001)).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    components = _components(pairs_of(good), 5, 80)
    assert {r.doc_id for r in single.collect()} == {c for _, c in components.values()}
    before = dict(pairs_of(single))
    for r in masked.collect():
        assert (r.text == before[r.doc_id]) or any(_base(before[r.doc_id]).values()) or "<" in r.text
        assert not any(_base(r.text).values()) and r.n_chars == len(r.text)
    words = lambda rows: sum(len(WORD.findall(t)) for _, t in rows)
    assert abs(words(pairs_of(mixed)) - words(pairs_of(masked))) <= 40
    assert packed.agg(F.sum("length")).first()[0] == sum(len(_ids(t)) for _, t in pairs_of(mixed))


OWN = ("_n", "_k", "_s", "_f", "_parts", "_r_k", "_r_n", "_gone", "_q", "_own_n", "_OWN_q", "_own__k", "_b", "_v", "_base", "_in", "_bb",
       "key", "row", "parts", "fp", "k1", "k2", "sig", "bands", "label", "kept", "piece", "start", "length", "n", "v", "a", "b", "o1", "h")


def test_stages_leave_other_columns_alone(spark, edge, empty):
    """Every internal name as a user's column: values stay, and an empty table stays empty."""
    text = " ".join(f"word{i} of the" for i in range(60))
    rows = [(i, text.replace("word", f"w{i}x") if i % 3 else text, "en", f"s{i % 2}", len(text)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in OWN:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c}:"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in OWN), name
        assert stage(spark, docs.limit(0), SF001).count() == 0, name
    packed = corpus_pipeline.STAGES[-1][1]
    assert packed(spark, docs, SF001).agg(F.count_distinct("doc_id")).first()[0] == 12
    assert packed(spark, docs.limit(0), SF001).count() == 0


def test_pipeline_run(spark):
    """The whole run on the given documents: rejected ones and all but one of each group are gone, sequences are gapless."""
    docs = docs_of(spark, SF001)
    out = corpus_pipeline.run(spark, SF001).collect()
    ids = {r["doc_id"] for r in out}
    good = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    stays = {r["doc_id"] for r in minhash.near_duplicates(docs.filter(F.col("doc_id").isin(list(good))), width=5, percent=80).filter("kept").collect()}
    assert ids and ids <= stays < good
    # the mix takes most of what it is offered
    assert len(ids) > 0.5 * len(stays)
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
