"""The corpus operators against plain versions, on awkward rows and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from newstide.llm import decontam, isoforest, packing, pairrank, rans, secret_scan, simhash, textstats, tokenizing, unigram, urlfilter, warc
from newstide.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
KEY = "0123456789abcdef0123456789abcdef"
LONG = "one two three four five six seven " * 3000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 20), (2, None), (3, ""), (4, LONG), (4, LONG), (None, "no id here"),
    (6, " \n\t x  y\r\n z "), (7, f'api_key = "{KEY}" and token: abc secret=secret=longvalue'), (8, "ÀÉ ſecret: Ωmega 日本 \xa0end <|endoftext|>"),
    (9, "AKIA" + "A1" * 10 + " akia" + "b" * 20), (10, "a"),
]
#: Names that operators use inside or add.
CLASH = ("kept", "score", "secrets", "fp", "part", "kinds", "text_key", "host", "n_tokens", "verdict", "label", "n_words", "key", "check", "counts", "kinds_", "text_key_", "secrets_", "verdict_")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit("mine") for c in CLASH})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- token ids and packing -----------------------------------------------------


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_are_the_librarys(path):
    library, rng = Tokenizer.from_file(path), random.Random(1)
    texts = [t for _, t in TEXTS if t] + ["".join(rng.choice("aB1 \n\t\r\xa0é'!_ſ́😀日s<|\x1c.") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    for text in [*texts, "", " ", "\n\n", "a\n b", "x  y", "I'M don't 12,3", "​a b"]:
        assert tokenizing.encoder(path).ids(text) == tokenizing.as_bytes(library.encode(text, add_special_tokens=False).ids)


def test_assign_fills_every_place_once():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.choice([1, 2, 63, 64, 65, rng.randint(1, 300)]) for _ in range(rng.randint(1, 60))]
        pieces = packing.assign(lengths, 64)
        for doc, length in enumerate(lengths):
            own = sorted((s, n) for d, s, n, _, _ in pieces if d == doc)
            assert [s for s, _ in own] == list(np.cumsum([0, *[n for _, n in own]])[:-1]) and sum(n for _, n in own) == length
        by_seq = {}
        for _, _, n, seq, offset in pieces:
            by_seq.setdefault(seq, []).append((offset, n))
        for own in by_seq.values():
            own.sort()
            assert [o for o, _ in own] == list(np.cumsum([0, *[n for _, n in own]])[:-1])
            total = sum(n for _, n in own)
            assert total <= 64 and total & (total - 1) == 0


def test_costs_are_balanced():
    rng = random.Random(3)
    pieces = packing.assign([rng.randint(1, 900) for _ in range(2000)], 1024, 1.0, 0.01)
    cost = {}
    for _, _, n, seq, _ in pieces:
        cost[seq] = cost.get(seq, 0) + n + 0.01 * n * n
    full = sorted(cost.values())[12:]
    assert np.std(full) / np.mean(full) < 0.25


def test_pack_awkward_rows(spark, docs, none):
    out = packing.pack(docs, WORD_BPE, shard_tokens=500).toPandas()
    library = Tokenizer.from_file(WORD_BPE)
    want = sorted(tokenizing.as_bytes([*library.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in TEXTS)
    joined, current = [], []
    for piece in out.sort_values(["doc_tokens", "doc_id", "start"]).itertuples():
        assert len(piece.ids) == 4 * piece.length
        current.append(piece)
    single = [p for p in current if p.doc_id not in (4,)]
    for key in {p.doc_id for p in single if p.doc_id == p.doc_id}:
        joined.append(b"".join(p.ids for p in sorted((p for p in single if p.doc_id == key), key=lambda p: p.start)))
    assert set(joined) <= set(want) and len(joined) == len(TEXTS) - 3
    assert out.length.sum() == sum(len(w) // 4 for w in want)
    assert packing.pack(none, WORD_BPE).count() == 0


# --- token files ----------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 4095, 4096, 4097, 20_000])
def test_segment_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) % 50_257).astype(np.uint32)
    data = rans.encode_segment(ids)
    assert (rans.decode_segment(data) == ids).all()
    if n > 2 * rans.BLOCK_TOKENS:
        assert (rans.decode_segment(data, 1, 2) == ids[rans.BLOCK_TOKENS : 2 * rans.BLOCK_TOKENS]).all()


def test_segment_extremes_and_damage():
    for ids in ([0, 2**32 - 1, 5], [7] * 9000, list(range(70_000))):
        ids = np.array(ids, np.uint32)
        assert (rans.decode_segment(rans.encode_segment(ids)) == ids).all()
    data = bytearray(rans.encode_segment(np.arange(9000, dtype=np.uint32) % 100))
    for at in (30, len(data) - 3):
        damaged = bytearray(data)
        damaged[at] ^= 1
        with pytest.raises(rans.ChecksumError):
            rans.decode_segment(bytes(damaged))


def test_token_files(spark, docs, none):
    path = scratch_path(spark, "t")
    rans.write_tokens(docs, path, BYTE_BPE)
    got = rans.read_tokens(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(BYTE_BPE)
    order = [(k, t or "") for k, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))]
    start = 0
    for row, (key, text) in zip(got, order, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (key, start, len(ids), tokenizing.as_bytes(ids))
        start += len(ids)
    rans.write_tokens(none, path + "-none", BYTE_BPE)
    assert rans.read_tokens(spark, path + "-none").count() == 0


# --- unigram counts ---------------------------------------------------------------


def test_unigram_against_library():
    rng = random.Random(4)
    for trial in range(200):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 3))): -float(rng.randint(1, 4)) for _ in range(rng.randint(1, 10))}
        if trial % 2:
            pieces |= {"▁": -2.0, "▁a": -2.0, "▁▁": -3.0}
        for byte in (False, True):
            own = unigram.Counter(unigram.Vocabulary(tuple(pieces.items()), byte))
            entries = [("<unk>", 0.0), *([(f"<0x{i:02X}>", 0.0) for i in range(256)] if byte else []), *pieces.items()]
            library = Tokenizer(models.Unigram(entries, 0, byte))
            for _ in range(8):
                text = "".join(rng.choice("abc  éz") for _ in range(rng.randint(1, 14)))
                assert own.count(text)[0] == len(library.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids)


def test_unigram_rows(spark, docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = unigram.token_counts(docs, path)
    assert got.columns[-2:] == ["n_tokens", "best_score"] and got.count() == len(TEXTS)
    by_id = {r.doc_id: r.n_tokens for r in got.collect()}
    assert by_id[2] == by_id[3] == 0 and by_id[4] > 3000
    assert unigram.token_counts(none, path).count() == 0


# --- SimHash ------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys):
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(keys):
        for j in range(i):
            if bin(a ^ keys[j]).count("1") <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(keys))]


def test_fingerprints():
    for _, text in [*TEXTS, (0, "One  two"), (0, "ONE"), (0, "É é X")]:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_links_within_and_across_tasks(spark, monkeypatch):
    rng = random.Random(5)
    keys = set()
    for base in (rng.getrandbits(64), 0, (1 << 64) - 1):
        weak = rng.sample(range(64), 9)
        for _ in range(120):
            keys.add(base ^ sum(1 << b for b in rng.sample(weak, rng.randint(0, 4))))
    keys = sorted(keys)
    want = plain_components(keys)
    monkeypatch.setattr(simhash, "TASK_ROWS", 40)  # many tasks, so that front blocks span them
    unique = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k, i) for i, k in enumerate(keys)], "fp long, first_id long")
    named = {r.fp: r.component_id for r in simhash.named_components(unique, 3).collect()}
    assert [named[k - (1 << 64) if k >> 63 else k] for k in keys] == want


def test_near_duplicates_rows(spark, docs, none):
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted((k, f) for k, f, _ in got if k) == sorted((k, plain_fingerprint(t)) for k, t in TEXTS if k)
    assert {c for k, _, c in got if k in (2, 3)} == {2} and {c for k, _, c in got if k == 4} == {4}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k in {c for _, _, c in got})
    assert simhash.keep_one(none).count() == 0


def test_star_contraction(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + rng.randint(1, 50)) for _ in range(60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[b] == 100 for a, b in edges if a == 100)


# --- secrets ------------------------------------------------------------------------


def plain_spans(text, rules=secret_scan.BASE):
    out = []
    for order, rule in enumerate(rules):
        flags = re.IGNORECASE | re.ASCII if rule.any_case else 0
        pattern = rule.pattern if not rule.any_case else re.sub("A-Za-z", "A-Za-z", rule.pattern)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text) if rule.any_case else text
        for m in re.finditer(pattern.replace("A-Za-z", "a-z") if rule.any_case else pattern, low, 0 if rule.any_case else flags):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), order, m.end(), rule.kind))
    return sorted(out)


def test_secret_spans(spark, docs, none):
    rng = random.Random(7)
    bits = ["token", "=", ": ", "secret", "api_key", "APIKEY", "passwd", '"', "abcdef", "AKIA", "Z9", "é", " ", "0123456789abcdef", "\n", "ſecret", "ab"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["token=abcdef " * 700, KEY * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.secrets] for r in secret_scan.find_secrets(df, secret_scan.BASE).collect()}
    assert got == {i: plain_spans(t) for i, t in enumerate(texts)}
    out = secret_scan.find_secrets(docs)
    assert out.count() == len(TEXTS) and "secrets" in out.columns
    assert {r.doc_id for r in out.where("size(secrets) > 0").collect()} == {7, 9}
    assert secret_scan.find_secrets(none).count() == 0


def test_redaction(spark, docs):
    texts = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert KEY not in texts[7] and texts[7].startswith("[SECRET]") and " and token: abc " in texts[7]
    assert texts[2] is None and texts[1] == TEXTS[0][1]


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == []
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [(frozenset({"aki", "kia"}),)]
    ((*choices,),) = secret_scan.trigram_query("(pass|word)x?y")
    assert frozenset({"pas", "ass", "ssy"}) in choices and frozenset({"wor", "ord", "rdx", "dxy"}) in choices


# --- urls -------------------------------------------------------------------------


def test_url_tokens_and_verdicts():
    index = urlfilter.RuleIndex(urlfilter.PATTERN_RULES, {"ads": 5, "login": 1})
    assert urlfilter.literal_tokens("/login^*^return=") == ["login", "return"] and urlfilter.literal_tokens("||casino") == []
    everything = [(p.startswith("@@"), re.compile(urlfilter.to_regex(p), re.DOTALL | re.ASCII)) for p in urlfilter.PATTERN_RULES]
    rng = random.Random(8)
    bits = ["http://", "casino", "-win.", "ads", ".", "/", "login", "?return=", "&", "example.net", "/ads/policy", "x.exe", "banner", "1.gif", "É", "wp-login.php", "^"]
    for _ in range(3000):
        url = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        hits = {spare for spare, p in everything if p.search(urlfilter.lower_ascii(url))}
        assert index.verdict(url) == ("block" if hits == {False} else "allow"), url


def test_url_rows(spark):
    data = [(1, "HTTP://A.Example.ORG/es/x?q#f"), (2, None), (3, "no scheme"), (4, "x://example.org"), (5, "x://notexample.org/es/"), (5, "x://b.com/de/1"), (6, "x://b.com?/fr/"), (None, "x://casino.b.net/")]
    got = rows(urlfilter.judge_urls(spark.createDataFrame(data, "page_id long, url string").withColumn("rule", F.lit("x"))))
    got = {(r[0], r[1]): r[2:] for r in got}
    assert got[1, data[0][1]] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2, None] == ("", "", None, "allow") and got[3, "no scheme"] == ("", "", None, "allow")
    assert got[4, "x://example.org"] == ("example.org", "", None, "allow")
    assert got[5, "x://notexample.org/es/"][2:] == ("org/", "allow") and got[5, "x://b.com/de/1"][2:] == ("com/de/", "block")
    assert got[6, "x://b.com?/fr/"] == ("b.com", "", None, "allow") and got[None, "x://casino.b.net/"][3] == "block"
    assert urlfilter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# --- quality ---------------------------------------------------------------------


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)]


def test_base_statistics():
    rng = random.Random(9)
    texts = [t or "" for _, t in TEXTS if (t or "") != LONG] + ["".join(rng.choice(["a ", "b ", "c\n", "É ", "# ", "\n", "\x0b", "<"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for text in texts:
        assert textstats.counts(text)[:5] == plain_base(text), text


def labelled(spark, every=4):
    rng = random.Random(10)
    words = ["alpha", "beta", "gamma", "delta", "over", "under", "around", "of", "the", "and", "in"]
    docs, marks = [], []
    for i in range(300):
        bad = i % every == 0
        text = " ".join((w + "###" if bad and rng.random() < 0.5 else w) + ("!!" if bad else "") for w in (rng.choice(words) + str(rng.randint(1, 99)) for _ in range(rng.randint(60, 200))))
        docs.append((i, text.upper() if bad else text))
        marks.append((i, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks + [(None, 1), (5, None), (999, 1)], "doc_id long, quality int")


def test_forest_rejects_the_odd(spark, docs, none):
    own, labels = labelled(spark, 10)  # anomalies are few
    model = isoforest.fit(own, labels)
    kept = {r.doc_id: r.kept for r in isoforest.judge(own, model).collect()}
    assert sum(kept[i] for i in range(300) if i % 10) >= 265 and sum(kept[i] for i in range(0, 300, 10)) <= 2
    got = isoforest.judge(docs, model)
    assert got.count() == len(TEXTS) and {r.doc_id: r.base_failed for r in got.collect()}[2]
    assert [tuple(r) for r in got.where("doc_id = 1").select(*textstats.BASE).collect()] == [tuple(plain_base(TEXTS[0][1]))]
    assert isoforest.judge(none, model).count() == 0
    free = isoforest.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert free.forest is None and isoforest.judge(docs, free).where("kept and base_failed").count() == 0


def test_pairwise_ranking(spark, docs, none):
    own, labels = labelled(spark)
    model = pairrank.fit(own, labels, usable=F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r for r in pairrank.score_quality(own, model).collect()}
    held = [i for i in range(0, 300, 3)]
    assert np.mean([got[i].predicted == (i % 4 != 0) for i in held]) > 0.95
    out = pairrank.score_quality(docs, model)
    assert out.count() == len(TEXTS) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert pairrank.score_quality(none, model).count() == 0
    blank = pairrank.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert {round(r.score, 6) for r in pairrank.score_quality(docs, blank).collect()} == {0.7}


# --- benchmark leaks ----------------------------------------------------------------


def test_block_max_wand_finds_all():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12)))) for i in range(70)]
    for block in (1, 4, 16):
        cfg = decontam.LeakConfig(least_score=0.4, block=block)
        index = decontam.ItemIndex(items, 64, cfg)
        for _ in range(150):
            terms = sorted({index.term[w] for w in rng.sample(vocab, rng.randint(0, 20)) if w in index.term})
            score = {}
            for t in terms:
                for item, weight in zip(*index.lists[t], strict=True):
                    score[item] = score.get(item, 0) + weight
            want = {i: s for i, s in score.items() if s >= 0.4}
            got = dict(index.retrieve(terms))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_leaks(spark, docs, none):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(20)) + ".\n" + " ".join(word() for _ in range(8)) + ".") for i in range(30)] + [(77, None), (78, ""), (0, None)]
    filler = lambda n: " ".join(word() for _ in range(n))
    texts = [(1, filler(500) + " " + items[3][1].upper() + " " + filler(90)), (2, items[4][1]), (2, items[4][1]), (3, filler(300)), (4, items[5][1][:60]), (5, None), (None, filler(63) + " " + items[6][1])]
    bench = spark.createDataFrame(items + items[:5], "item_id long, text string")
    own = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    scores = []
    for cfg in (decontam.LeakConfig(), decontam.LeakConfig(shard_items=7)):
        found = decontam.find_leaks(own, bench, cfg).collect()
        scores.append(sorted((str(r.doc_id), r.item_id, round(r.score, 9)) for r in found))
        got = [(r.doc_id, r.item_id) for r in found]
        assert sorted(got, key=str) == sorted([(1, 3), (2, 4), (2, 4), (None, 6)], key=str)
        left = decontam.drop_leaked(own, bench, cfg)
        assert left.columns == own.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5]
    assert scores[0] == scores[1]  # counts are those of the whole benchmark
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(own, empty).count() == 0 and decontam.drop_leaked(own, empty).count() == len(texts)
    assert decontam.find_leaks(none, bench).count() == 0 and decontam.drop_leaked(none, bench).count() == 0


# --- WARC ---------------------------------------------------------------------------


def test_warc_round_trip(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    data = [(1, "http://a/x", inner * 3 + "y" * 200), (2, "u", None), (3, None, ""), (4, "u", "A" * 150), (5, "u\r\nv", "A" * 150), (6, "x", "WARC/1."), (7, "x", inner * 40)]
    data += [(8, "x", "é" * 60), (9, "x", "é" * 60), (None, "x", "A" * 150), (10, "x", "\r\n\r\n" * 50), (4, "dup", "A" * 150), (11, "x", "z" * 99), (12, "x", "z" * 99)]
    data += [(100 + i, "z", f"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: {i * 7}\r\n\r\n" + "q" * i) for i in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(2)
    path = scratch_path(spark, "w")
    warc.write_pages(pages, path)
    first = {}
    for key, _, html in data:
        body = (html or "").encode()
        if len(body) >= 100 and key is not None:
            first[body] = min(first.get(body, key), key)
    want = []
    for key, _, html in data:
        body = (html or "").encode()
        to = first.get(body, key)
        want.append((key, len(body), hashlib.sha256(body).hexdigest(), "response" if to == key else "revisit", None if to == key else to))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("3000", "100m"):  # in many splits and in one
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert rows(warc.page_payloads(spark, path)) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    payloads = {bytes(r.payload).decode() for r in warc.read_records(spark, path).collect()}
    assert payloads >= {h for _, _, h in data if h}
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), path + "-none")
    assert warc.page_payloads(spark, path + "-none").count() == 0


def test_warc_chain_ends_at_a_cut_record(spark):
    record = lambda body, n: f"WARC/1.1\r\nWARC-Record-ID: <urn:page:{n}>\r\nWARC-Type: response\r\nContent-Length: {len(body)}\r\n\r\n{body}"
    path = scratch_path(spark, "cut")
    whole = [record("one", 1), record("two", 2), "WARC/1.1\r\nContent-Length: 900\r\n\r\nshort", record("lost", 3)]
    spark.createDataFrame([(r,) for r in whole], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert sorted(bytes(r.payload) for r in warc.read_records(spark, path).collect()) == [b"one", b"two"]


def test_warc_magic_in_urls_and_at_odd_places(spark):
    spec = "https://iipc.github.io/warc-specifications/WARC/1.1/"
    urls = ["http://a/", spec, spec + "WARC/1.0", "WARC/1.1", "http://b/WARC/1.\r\nWARC/1.1", None, "http://c/"]
    bodies = ["x" * 30, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n", "\nWARC/1.", "\nWARC/1.WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n\nWARC/1.", "é\r\n", "\r\n\r\n", "", "S" * 300]
    data = [(i, urls[i % 7], bodies[i % 8]) for i in range(112)]
    path = scratch_path(spark, "urls")
    warc.write_pages(spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("611", "100m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.page_payloads(spark, path).collect()}
            assert got == {i: (len(b.encode()), hashlib.sha256(b.encode()).hexdigest()) for i, _, b in data}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    heads = {int(re.search(r"urn:page:(\d+)", r["head"])[1]): re.search(r"(?m)^WARC-Target-URI: ([^\r\n]*)", r["head"])[1] for r in warc.read_records(spark, path).collect()}
    assert heads == {i: re.sub("[\r\n]+", " ", u or "") for i, u, _ in data}
    # What stands before the first record of a file is passed over, with and without a line end.
    record = "WARC/1.1\r\nContent-Length: 3\r\n\r\none\r\n\r\n"
    for before_it in ("", "junk", "junk\n", "é\r\n"):
        path = scratch_path(spark, "lead")
        spark.createDataFrame([(before_it + record * 2,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
        assert [(r.offset, bytes(r.payload)) for r in warc.read_records(spark, path).orderBy("offset").collect()] == [(n, b"one") for n in (len(before_it.encode()), len(before_it.encode()) + len(record))]


# --- registered queries ----------------------------------------------------------------


def test_crc_rule_of_held_out_rows(spark):
    from newstide.llm.queries import held_out

    got = {r.doc_id: r.h for r in spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out("doc_id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}


def test_sql_of_queries(spark):
    from compare import connect, differences

    from newstide.llm.oracle import oracle_sql
    from newstide.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.001"
    con = connect(sf)
    for name, sql in oracle_sql().items():
        assert differences(REGISTRY[name](spark, sf), con, sql) is None, name


def test_every_operator_has_a_query():
    from newstide.llm.queries import REGISTRY

    assert {int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY} == set(range(1, 14))


def test_pipeline_against_plain_version(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    source = docs.toPandas().set_index("doc_id")
    bench = [decontam.words_of(t) for t in pd.read_parquet(f"{sf}/benchmark.parquet").text]
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, sf)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        kept[name] = docs.toPandas().set_index("doc_id")
        assert list(kept[name].columns) == list(source.columns)
    base = {i for i, t in source.text.items() if (b := plain_base(t))[0] >= 50 and 100 * b[4] <= 50 * b[0]}
    assert set(kept["quality rules"].index) <= base
    groups = {}
    ids = sorted(kept["quality rules"].index)
    for i, root in zip(ids, plain_components([plain_fingerprint(source.text[i]) for i in ids]), strict=True):
        groups.setdefault(root, []).append(i)
    assert set(kept["near-dedup"].index) == {min(g) for g in groups.values()}
    clean = set()
    for i in kept["near-dedup"].index:
        text = " " + " ".join(decontam.words_of(source.text[i])) + " "
        if not any(" " + " ".join(b) + " " in text for b in bench):
            clean.add(i)
    assert set(kept["decontamination"].index) == clean
    last = kept["secret scans"]
    assert set(last.index) == clean
    for i, row in last.iterrows():
        spans = plain_spans(source.text[i], secret_scan.BASE + secret_scan.EXTRA)
        assert (row.text == source.text[i]) == (not spans) and row.n_chars == len(row.text)
    packed = corpus_pipeline.run(spark, sf).toPandas()
    assert set(packed.doc_id) == clean
    library = Tokenizer.from_file(WORD_BPE)
    assert packed.length.sum() == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in last.text)


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return words


def test_quality_stage_leaves_columns_alone(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    names = [*textstats.BASE, "base_failed", "anomaly", "kept", "verdict__"]
    kept = corpus_pipeline.quality_rules(spark, plain.withColumns({c: F.lit("mine") for c in names}), sf)
    assert kept.columns == [*plain.columns, *names]
    assert {tuple(r[c] for c in names) for r in kept.collect()} == {("mine",) * len(names)}
    model = isoforest.fit(plain, spark.read.parquet(f"{sf}/labels.parquet"))
    assert rows(kept.select(*plain.columns)) == rows(isoforest.judge(plain, model).where("kept").select(*plain.columns))


def test_cheapest_of_all_sequences_with_room():
    rng = random.Random(23)
    for _ in range(200):
        seq_len = rng.choice([64, 100])
        lengths = [rng.choice([rng.randint(1, 12), rng.randint(30, 60)]) for _ in range(rng.randint(1, 120))]
        waiting = sorted((-n, i, 0) for i, n in enumerate(lengths))
        full, rest = divmod(sum(lengths), seq_len)
        sizes = [seq_len] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        open_ = [(float(seq_len - n), i, 0, n) for i, n in enumerate(sizes)]
        want = []
        while waiting:
            minus, doc, start = waiting.pop(0)
            cost, seq, used, size = chosen = min([x for x in open_ if x[3] - x[2] >= -minus] or [x for x in open_ if x[3] > x[2]])
            put = min(-minus, size - used)
            want.append((doc, start, put, seq, used))
            open_[open_.index(chosen)] = (cost + put + put * put / 24576, seq, used + put, size)
            if put < -minus:
                waiting = sorted([*waiting, (minus + put, doc, start + put)])
        assert packing.assign(lengths, seq_len) == want


def test_edited_items_are_leaks():
    rng = random.Random(24)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    # Answers of two words, of one sentence, and long ones.
    items = [(i, ". ".join(" ".join(word() for _ in range(n)) for n in [(30, 2), (24,), (20, 12), (12, 9, 3)][i % 4])) for i in range(40)]
    index = decontam.ItemIndex(items, 128, decontam.LeakConfig())
    filler = lambda: [word() for _ in range(70)]
    for key, text in items:
        words = decontam.words_of(text)
        for part in (words, words[:-1], edited(rng, words, 1)):
            assert [h[0] for h in index.search(" ".join([*filler(), *part, *filler()]))] == [key]
        shuffled = rng.sample(words, len(words))  # the same words in another order are no copy
        assert not index.search(" ".join(shuffled)) and not index.search(" ".join(words[: len(words) // 2]))
