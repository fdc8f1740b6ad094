"""Operators that work row by row or block by block, against the libraries and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filing_jobs.llm import isomedia, langid, packing, queries, spbpe, tokenfile, tokens, topk
from filing_jobs.llm.common import stored
from filing_jobs.llm.tokens import encoder

ODD = [None, "", " ", "a", "The  cat\n\tsat.", "don't I'LL it's'", "<|endoftext|> x <|startoftext|>", "\x1c\x85\xa0 x　y", "ÀÉ中文 字,é́ İΣΑΣ", "😀" * 3, "x" * 3000, "ab " * 20_000, "1234.5%, a1b2", "é ́a ﬁ ½ ²", "\x00\x01", "...!?", " .a b.c "]


def random_texts(n, seed=3):
    r = random.Random(seed)
    letters = "abct  heringABCTHE..,,'\n\té中文字▁😀123 <0x0A> <s>ﬁ²́"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(n)]


def frame(spark, texts, **more):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, t string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_the_library(name):
    own, library = encoder(P.path(name)), Tokenizer.from_file(P.path(name))
    for text in ODD[1:] + random_texts(3000):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


MARKS = [chr(c) for c in range(32, 128) if not chr(c).isalnum()]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_mixed_texts_in_batches_equal_the_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 700)
    monkeypatch.setattr(tokens, "MEMO", 5000)
    monkeypatch.setattr(tokens, "STAY", 1000)
    r = random.Random(11)
    changing = "İIıiŞşĞğẞßΣσςŐőÅKſŉǅǰΐΰﬁﬃÉ\u0301\u0307\u0338\u0327\u0345"
    pool = changing * 2 + "".join(MARKS) + "abcXYZ012 \t\n\xa0 中あ😀é़́ः"
    texts = ["".join(r.choice(pool) if r.random() < 0.7 else chr(r.choice([r.randrange(0x20, 0x250), r.randrange(0x370, 0x600), r.randrange(0x1E00, 0x2100), r.randrange(0x1F000, 0x1F700)])) for _ in range(r.randint(0, 30))) for _ in range(20_000)]
    texts += [f"BİLGİ{m}{x}" for m in MARKS for x in ("", "a", " İ", "1")] + ["BİLGİ.", None, "word " * 4000, "<|endoftext|>"]
    own, library = tokens.PieceEncoder(P.path(name)), Tokenizer.from_file(P.path(name))
    for text, got in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_new_words_go_to_the_library_together():
    """A call for each new word cost most of op9's time."""
    path = P.path("word_bpe_49k.json")
    own, library, r = tokens.PieceEncoder(path), Tokenizer.from_file(path), random.Random(12)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzßäéñøœıĸŉǆɏ") for _ in range(r.randint(1, 14))) for _ in range(5000)]
    sent = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

    own.library = Counting(own.library)
    if getattr(own, "bare", None):
        own.bare = Counting(own.bare)
    for text, got in zip(words, own.encode_all(words), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(sent) <= 10, len(sent)


def test_prefix_table_equals_the_library(spark):
    path = P.path("piece_bpe_32k.model")
    own, library = spbpe.encoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ODD[1:] + random_texts(3000):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, repr(text[:80])
    got = {r["doc_id"]: r for r in spbpe.encode(frame(spark, ODD), path).collect()}
    assert spbpe.encode(frame(spark, []), path).count() == 0 and spbpe.digests(frame(spark, []), path).count() == 0
    digests = {r["doc_id"]: r for r in spbpe.digests(frame(spark, ODD), path).collect()}
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got[i]["ids"] == ids and got[i]["decoded"] == library.decode(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and digests[i]["n_tokens"] == len(ids)
        assert digests[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_packing(spark):
    path = P.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), ODD + random_texts(50)
    rows = packing.pack(frame(spark, texts), path, window=64).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["length"] for r in own] == packing.lengths(len(ids), 64) and all(r["doc_tokens"] == len(ids) and r["offset"] == 0 for r in own)
        assert b"".join(bytes(r["ids"]) for r in own) == np.array(ids, "<u4").tobytes()
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:k]) for k in range(len(own))]
    crc = packing.pack(frame(spark, texts), path, window=64, with_ids=False).collect()
    assert sorted(r["ids_crc32"] for r in crc) == sorted(zlib.crc32(bytes(r["ids"])) for r in rows)
    assert sum(r["sequences"] for r in packing.buckets(packing.pack(frame(spark, texts), path)).collect()) > 0
    assert packing.pack(frame(spark, []), path).count() == 0
    for n in range(1, 300):
        parts = packing.lengths(n, 32)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 32 for p in parts)


def test_token_files(spark):
    path = P.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), ODD + random_texts(200)
    table = stored(tokenfile.files(frame(spark, texts).repartition(5), path, block=97, file_ids=500), "t")
    got = {r["doc_id"]: r for r in tokenfile.read_documents(table).collect()}
    at = 0
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(texts) and tokenfile.read_documents(tokenfile.files(frame(spark, []), path)).count() == 0
    data = [np.arange(k, dtype="<u4").tobytes() for k in (1, 300, 0, 7)]
    own = tokenfile.TokenFile(tokenfile.file_bytes(data, block=10))
    assert own.lengths.tolist() == [1, 300, 0, 7] and own.ids(5, 25).tobytes() == b"".join(data)[20:100] and own.ids(3, 3).size == 0
    with pytest.raises(ValueError):
        tokenfile.TokenFile(b"something else")


def test_media(spark):
    rows = {r["doc_id"]: r for r in isomedia.features(isomedia.to_media(frame(spark, ODD)), carry=("n_bytes",)).collect()}
    for i, text in enumerate(ODD):
        data = (text or "").encode()
        payload = data + bytes(max(64, math.ceil(len(data) / 64) * 64) - len(data))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len(data), len(payload), zlib.crc32(payload[-64:]))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["feature"].startswith("soun/raw ")
    assert rows[0]["media_sha256"] == rows[1]["media_sha256"]
    broken = spark.createDataFrame([(1, None), (2, b"nothing"), (3, isomedia.write_media(b"abc")[:100])], "doc_id long, media binary")
    assert [r["payload_bytes"] for r in isomedia.features(broken).orderBy("doc_id").collect()] == [0, 0, 0]


def test_media_query_gives_all_keyframe_ranges_of_what_it_stored(spark, tmp_path, monkeypatch):
    text = "ab " * 100_000
    frame(spark, [text, None]).write.parquet(str(tmp_path / "documents.parquet"))
    names = []
    monkeypatch.setattr(queries, "stored", lambda df, name: names.append(name) or stored(df, name))
    rows = {r["doc_id"]: r for r in queries.op8_media_columns(spark, str(tmp_path)).collect()}
    (track,) = rows[0]["tracks"]
    (own,) = isomedia.read_media(isomedia.write_media(isomedia.padded(text.encode())))
    assert names == ["media"] and [tuple(x) for x in track["keyframes"]] == [tuple(x) for x in own.keyframes().tolist()] and len(track["keyframes"]) == 5
    assert (track["codec"], track["samples"], track["duration"]) == ("raw", 300_032, 300_032 / 8000) and len(rows[1]["tracks"]) == 1


def test_media_keyframes_of_several_samples_in_a_chunk():
    b, f = isomedia.box, isomedia.full
    u = lambda *x: b"".join(v.to_bytes(4, "big") for v in x)
    table = b(b"stbl", f(b"stsd", u(1), b(b"avc1", bytes(8))), f(b"stts", u(1, 5, 10)), f(b"stsc", u(2, 1, 2, 1, 3, 1, 1)), f(b"stsz", u(0, 5, 10, 20, 30, 40, 50)), f(b"stco", u(3, 1000, 2000, 3000)), f(b"stss", u(3, 1, 4, 5)))
    movie = b(b"ftyp", b"isom", bytes(4)) + b(b"mdat", bytes(9)) + b(b"moov", b(b"trak", b(b"mdia", f(b"mdhd", u(0, 0, 100, 50), bytes(4)), f(b"hdlr", bytes(4), b"vide", bytes(13)), b(b"minf", table))))
    (track,) = isomedia.read_media(movie)
    assert (track.codec, track.handler, track.timescale, track.duration, track.samples) == ("avc1", "vide", 100, 50, 5)
    assert track.keyframes().tolist() == [[1000, 10], [2030, 40], [3000, 50]] and track.ranges().tolist() == [[1000, 30], [2000, 70], [3000, 50]]
    data = bytes(range(256)) * 1000
    media = isomedia.write_media(data, chunk=1000)
    (track,) = isomedia.read_media(media)
    assert isomedia.payload_of(media, track) == data and len(track.keyframes()) == 256


def test_broken_containers_have_defined_results(spark):
    good = isomedia.write_media(b"abc" * 50, chunk=40)
    u = lambda *x: b"".join(v.to_bytes(4, "big") for v in x)
    b, f = isomedia.box, isomedia.full
    video = b(b"moov", b(b"trak", b(b"mdia", f(b"mdhd", bytes(16)), b(b"minf", b(b"stbl", f(b"stts", u(1, 5, 10)), f(b"stsc", u(2, 1, 2, 1, 3, 1, 1)), f(b"stsz", u(0, 5, 10, 20, 30, 40, 50)), f(b"stco", u(3, 1000, 2000, 3000)), f(b"stss", u(3, 1, 4, 5)))))))
    r = random.Random(8)
    broken = [whole[:n] for whole in (good, video) for n in range(len(whole))]
    for whole in (good, video):
        for at in range(len(whole)):
            for four in (b"\xff" * 4, bytes(4), b"\x11\xe1\xa3\x00", b"\x80\0\0\0"):
                broken.append(whole[:at] + four + whole[at + 4 :])
        broken += [bytes(r.choice([x, 0, 255]) if r.random() < 0.05 else x for x in whole) for _ in range(500)]
    short = [b(b"moov", b(b"trak", b(b"mdia", f(kind, bytes(n), version=v)))) for kind in (b"stsz", b"stts", b"stsc", b"stco", b"co64", b"stss", b"mdhd", b"hdlr", b"stsd") for n in range(40) for v in (0, 1)]
    deep = b""
    for _ in range(3000):
        deep = b(b"moov", deep)
    for data in [*broken, *short, deep]:
        tracks = isomedia.read_media(data)
        assert isinstance(isomedia.feature_of(tracks), str) and len(isomedia.columns_of(tracks)) == len(tracks)
        assert all(len(isomedia.payload_of(data, t)) <= len(data) for t in tracks)
    large = isomedia.Track(samples=300_000_000, fixed_size=1, runs=np.array([[1, 300_000_000, 1]]), chunks=np.array([8]), sync=np.array([7]))
    assert large.ranges().tolist() == [[8, 300_000_000]] and large.keyframes().tolist() == [[14, 1]]
    assert isomedia.features(isomedia.to_media(frame(spark, []))).count() == 0


def brute_top(rows, k):
    valid = {i: v for i, v in rows if i is not None and v is not None and None not in v and all(math.isfinite(x) for x in v)}
    quantised = {i: [math.floor(64 * x) for x in v] for i, v in valid.items()}
    out = []
    for q, a in quantised.items():
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in quantised.items() if i != q and len(b) == len(a))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("k,scale,block", [(5, 1.0, 16), (3, 1e6, 7), (40, 0.01, 16)])
def test_top_k(spark, k, scale, block):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) * scale for _ in range(4)]) for i in range(150)] + [(200 + i, [0.5 * scale] * 4) for i in range(60)]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0]), (302, [math.nan] * 4), (303, [math.inf] * 4), (320, [1.0, 2.0]), (321, [3.0, 1.0]), (340, []), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit(1)).repartition(4)
    got = topk.search(df, F.col("vec_id") % 20 == 0, k=k, block=block, bins=8).collect()
    assert sorted(tuple(x) for x in got) == brute_top(rows, k)


def test_top_k_of_repeated_ids_with_broken_rows(spark):
    r = random.Random(15)
    odd = lambda v: r.choice([v, v, v, v, None, [None, *v[1:]], [*v[:-1], math.nan], [math.inf, *v[1:]], v[:2], []])
    rows = [(r.choice([None, *range(50)]), odd([r.gauss(0, 1) for _ in range(3)])) for _ in range(400)] + [(40, [None, 1.0]), (40, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    valid = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for q in sorted({i for i, _ in valid if i % 20 == 0}):  # as the SQL: all pairs of all rows of an id
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for p, a in valid if p == q for i, b in valid if i != q and len(a) == len(b))
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:6], 1)]
    for block in (7, 4096):
        assert sorted(tuple(x) for x in topk.search(df, F.col("vec_id") % 20 == 0, k=6, block=block, bins=16).collect()) == want


@pytest.mark.parametrize("bins", [1024, 100, 7])
def test_top_k_where_many_scores_share_few_values(spark, bins):
    r = random.Random(6)
    rows = [(i, [float(r.randint(-4, 4)) for _ in range(12)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.search(df, F.col("vec_id") % 20 == 0, k=5, scale=1.0, block=100, bins=bins).collect()
    quantised = [(i, [x / 64 for x in v]) for i, v in rows]
    assert len(got) == 150 and sorted(tuple(x) for x in got) == brute_top(quantised, 5)


def test_top_k_sends_no_blocks_through_the_driver(spark, monkeypatch):
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(topk, "stored", lambda df, name: plans.append(plan(df)) or stored(df, name))
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = topk.search(df, F.col("vec_id") % 20 == 0, k=3, block=50, bins=4)
    plans.append(plan(found))
    assert len([p for p in plans if "Join" in p]) > 2 and not [p for p in plans if "Broadcast" in p]
    assert sorted(tuple(x) for x in found.collect()) == brute_top(rows, 3)


def test_top_k_of_nothing_and_of_huge_components(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(empty, F.col("vec_id") % 20 == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 3.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    assert [x["vec_id"] for x in topk.search(huge, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] == [1, 2]


def test_top_k_of_scores_near_the_end_of_longs(spark):
    top = 2.0**62 - 2**10
    rows = [(0, [top, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 5.0]), (3, [1.0, -9.0]), (4, [-1.0, 3.0]), (5, [2.0, -3.0]), (6, [-2.0, 1.0]), (7, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, F.col("vec_id") == 0, k=4, scale=1.0, bins=8, block=3).orderBy("rank").collect()
    score = {i: int(top) * int(v[0]) + int(v[1]) for i, v in rows[1:]}
    want = sorted(score, key=lambda i: (-score[i], i))[:4]
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, score[i]) for i in want] and score[want[0]] > 1 << 62
    assert topk.products(np.array([[top]]), np.array([[4.0], [-4.0]])).tolist() == [[topk.MOST, -topk.MOST]]


def brute_language(rows, text):
    """Words by their log frequency, unseen ones by the longest known n-gram that ends at each place; all rows teach."""
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    langs = sorted({lang for _, lang in rows})
    words = {lang: Counter(w for t, x in rows if x == lang for w in split(t)) for lang in langs}
    grams = {n: {lang: Counter() for lang in langs} for n in range(1, 6)}
    for lang in langs:
        for w, c in words[lang].items():
            for n in grams:
                for at in range(len(w) + 3 - n):
                    grams[n][lang][f"^{w}$"[at : at + n]] += c
    words = {lang: Counter({w: c for w, c in found.items() if c >= 2}) for lang, found in words.items()}
    half = lambda table, lang: sum(table[lang].values()) + 0.5 * len([x for x in table[lang].values() if x]) + 1
    log = lambda table, key, lang: math.log((table[lang][key] + 0.5) / half(table, lang) if table[lang][key] else 0.5 / max(half(table, x) for x in langs))

    def others(table, key, lang):
        rest = [x for x in langs if x != lang]
        theirs = sum(table[x][key] for x in rest)
        if not theirs:
            return math.log(0.5 / max(half(table, x) for x in langs))
        return math.log((theirs + 0.5) / (sum(sum(table[x].values()) for x in rest) + 0.5 * len({g for x in rest for g in table[x] if table[x][g]}) + 1))

    total, shares = dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 0.0)
    for w in split(text):
        own, other, padded = dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 0.0), f"^{w}$"
        found = [(words, w)] if any(w in words[lang] for lang in langs) else []
        for end in range(1, len(padded) + 1) if not found else ():
            n = next((n for n in range(min(5, end), 0, -1) if any(padded[end - n : end] in grams[n][lang] for lang in langs)), None)
            found += [(grams[n], padded[end - n : end])] if n else []
        for lang in langs:
            for table, key in found:
                own[lang] += log(table, key, lang)
                other[lang] += others(table, key, lang)
            total[lang] += own[lang]
            shares[lang] += 1 / (1 + math.exp(other[lang] - own[lang]))
    best = max(langs, key=lambda lang: total[lang])
    return best, shares[best] / len(split(text))


def test_language_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(langid, "PART", 3)
    monkeypatch.setattr(langid, "MEMO", 20)
    r = random.Random(9)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(1, 6)))
    rows = [(" ".join(word(letters) for _ in range(r.randint(1, 15))), lang) for _ in range(15) for lang, letters in (("aa", "abcd"), ("bb", "cdef"), ("cc", "aefé"))]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(df)
    asked = [t for t, _ in rows[:9]] + ["ABCD zz q", "fed. cab, 7 é", "z", " ".join(word("abcdefé") for _ in range(40))]
    got = {x["doc_id"]: x for x in langid.predict(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(asked):
        lang, score = brute_language(rows, text)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score), text
    assert langid.predict(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        langid.fit(df, max_languages=2)
    low = langid.keep_identified(df, min_score=0.9).count()
    fitted = langid.fit(df.where(~langid.held_out()))
    assert low == sum(x["score"] >= 0.9 for x in langid.predict(df, fitted).collect()) < len(rows)
    unlabelled = spark.createDataFrame([(1, "abc", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [x["doc_id"] for x in langid.keep_identified(unlabelled).collect()] == [1]


def test_many_labels_change_little(spark):
    r = random.Random(6)
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["sch", "keit", "ung", "der"], "cc": ["eau", "oux", "elle", "que"]}
    word = lambda lang: "".join(r.choice(parts[lang]) for _ in range(r.randint(1, 3)))
    rows = [(i, " ".join(word(lang) for _ in range(60)), lang) for i, lang in enumerate(r.choice("aa bb cc".split()) for _ in range(600))]
    letters = lambda: "".join(r.choice("bdfgjkmpqvxz") for _ in range(r.randint(2, 6)))
    small = [(10_000 + i, " ".join(letters() for _ in range(8)), f"small{i % 20}") for i in range(80)]
    junk = [(20_000 + i, " ".join(word(r.choice(list(parts))) for _ in range(5)), f"junk{i % 1000}") for i in range(2000)]
    ids = {i for i, _, _ in rows}
    means, right = [], []
    for more in ([], small, junk):
        df = spark.createDataFrame(rows + more, "doc_id long, text string, lang string")
        model = langid.fit(df, most_languages=1500)
        assert len(model.languages) == 3 + len({x for _, _, x in more})
        found = [x for x in langid.predict(df, model).collect() if x["doc_id"] in ids]
        means.append(sum(x["score"] for x in found) / len(found))
        right.append(sum(x["lang_pred"] == rows[x["doc_id"]][2] for x in found))
        kept = {x["doc_id"] for x in langid.keep_identified(df).collect()}
        assert ids <= kept
    assert abs(means[1] - means[0]) < 0.02 and right[0] == right[1] == len(rows) and right[2] > 0.95 * len(rows), (means, right)
    assert len(langid.fit(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string"), most_languages=3).languages) == 3


def test_language_id(spark):
    r = random.Random(1)
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["sch", "keit", "ung", "der"], "cc": ["eau", "oux", "elle", "que"]}
    word = lambda lang: "".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(12)), lang) for i, lang in enumerate(r.choice("aa bb cc".split()) for _ in range(400))]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 + 3 !²", "cc"), (1003, "thething " * 5000, None), (None, "scheung", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("t", F.lit(0))
    got = {x["doc_id"]: x for x in langid.predict(df, langid.fit(df.where(~langid.held_out()))).collect()}
    assert len(got) == len(rows) and all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert got[1003]["lang_pred"] == "aa" and got[None]["lang_pred"] == "bb" and all(0 <= x["score"] <= 1 for x in got.values())
    held = [i for i, _, _ in rows[:400] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["lang_pred"] == rows[i][2] for i in held) >= 0.95 * len(held)
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    nothing = langid.fit(df.limit(0))
    assert {x["lang_pred"] for x in langid.predict(df, nothing).collect()} == {"und"}
