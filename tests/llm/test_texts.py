"""Operators that treat each text by itself: 1, 2, 4, 5, 8."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.llm import licenses, media, parts, pieces, spm_model, token_counts, token_files
from seqsieve.llm.common import shared_path
from seqsieve.llm.queries import tokenizer_path

PIECES = "piece_bpe_32k.model"


def by_row(frame):
    return Counter(tuple(r) for r in frame.collect())


# 1


def plain_counts(word, scores, floor):
    best = [(0.0, 0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[i][0] + scores[word[i:end]], best[i][1] + 1, best[i][2]) for i in range(end) if word[i:end] in scores]
        if word[end - 1] not in scores:
            found.append((best[end - 1][0] + floor - token_counts.PENALTY, best[end - 1][1] + len(word[end - 1].encode()), best[end - 1][2] + 1))
        best.append(max(found))
    return best[-1]


def test_token_counts_equal_plain_segmentation(spark, docs, rows, empty):
    scores = token_counts.zipf_scores(spm_model.load(tokenizer_path(PIECES)))
    floor = min(scores.values())
    known = {}
    expected = Counter()
    for i, text in rows:
        found = (text or "").split()
        for w in found:
            if w not in known:
                known[w] = plain_counts("▁" + w, scores, floor)
        expected[i, len(found), sum(known[w][1] for w in found), sum(known[w][2] for w in found), round(sum(known[w][0] for w in found), 4)] += 1
    got = token_counts.token_counts(docs, tokenizer_path(PIECES))
    assert Counter((*tuple(r)[:4], round(r["log_prob"], 4)) for r in got.collect()) == expected
    assert any(k[3] for k in expected)
    assert token_counts.token_counts(empty, tokenizer_path(PIECES)).count() == 0


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer, models

    scores = token_counts.zipf_scores(spm_model.load(tokenizer_path(PIECES)))
    library = Tokenizer(models.Unigram([("<unk>", -100.0), *scores.items()], 0, False))
    trie = token_counts.PrefixTrie(scores)
    for word in ["▁the", "▁tokenisation", "▁abcabcabc", "▁Straße", "▁a.b,c", "▁" + "ab" * 40]:
        assert trie.add(word)[0] == len(library.encode(word).ids)


def test_trie_is_reset_and_shares_prefixes(monkeypatch):
    scores = {"▁": -1.0, "a": -2.0, "ab": -2.5, "b": -2.0}
    trie = token_counts.PrefixTrie(scores)
    trie.add("▁ab")
    nodes = len(trie.best)
    assert trie.add("▁aba")[0] == 3 and len(trie.best) == nodes + 1
    monkeypatch.setattr(token_counts, "MAX_NODES", 2)
    assert trie.add("▁ab") == (2, 0, -3.5) and len(trie.best) == 4


# 2


def test_media_with_filling_before_markers():
    data, lengths, _ = media.payloads(np.frombuffer(b"some text", np.uint8), np.array([0, 9]))
    item = media.encode_payloads(data, lengths)[0]
    filled = item[:2] + b"\xff\xff" + item[2:].replace(b"\xff\xda", b"\xff\xff\xda", 1)
    assert filled != item and np.array_equal(media.thumbnails([filled])[0][0], media.thumbnails([item])[0][0])


def test_media_of_a_long_text_take_bounded_memory():
    import tracemalloc

    body = np.random.default_rng(3).integers(32, 127, 12_000_000, dtype=np.uint8)
    tracemalloc.start()
    try:
        data, lengths, _ = media.payloads(body, np.array([0, len(body)]))
        items = media.encode_payloads(data, lengths)
        frames = media.thumbnails(items)[0]
        told = media.feature(frames)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert b"".join(f.tobytes() for f in frames)[: len(body)] == body.tobytes() and told.split(":")[1] == str(len(frames)) != "1"
    assert peak < 150 << 20, peak  # some copies of the text, and work on a few frames; before, 54 bytes for each of its bytes


def test_media_round_trip(spark, docs, rows, empty):
    got = media.read_features(media.store_texts(docs)).collect()
    expected = Counter()
    for i, text in rows:
        body = (text or "").encode()
        payload = body + b"\xff" * (max(-(-len(body) // 576), 1) * 576 - len(body))
        expected[i, len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])] += 1
    assert Counter(tuple(r)[:5] for r in got) == expected
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.store_texts(docs).collect()}
    for r in got:
        if r["doc_id"] not in (None, 0, 41):
            item = stored[r["doc_id"]]
            assert (r["media_bytes"], r["media_sha256"]) == (len(item), hashlib.sha256(item).hexdigest())
    assert media.read_features(media.store_texts(empty)).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=3000), min_size=1, max_size=5))
def test_media_of_any_bytes(texts):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data, lengths, _ = media.payloads(np.frombuffer(b"".join(texts), np.uint8), offsets)
    items = media.encode_payloads(data, lengths)
    for text, n, frames in zip(texts, lengths, media.thumbnails(items), strict=True):
        assert b"".join(f.tobytes() for f in frames) == text + b"\xff" * (n - len(text))


def test_media_of_several_frames_and_markers():
    body = np.random.RandomState(1).randint(0, 256, media.FRAME_ROWS * media.WIDTH + 700, np.uint8)
    data, lengths, _ = media.payloads(body, np.array([0, len(body)]))
    item = media.encode_payloads(data, lengths)[0]
    frames = media.parse_frames(item)
    assert [(f.width, f.height, f.restart) for f in frames] == [(192, 8 * media.FRAME_ROWS, 24), (192, 8 * 48, 24)]
    assert b"".join(f.tobytes() for f in media.thumbnails([item])[0])[: len(body)] == body.tobytes()
    with pytest.raises(ValueError):
        media.parse_frames(b"\x00\x01")


def plain_feature(text):
    """The feature of a text by loops over its payload, a picture of one byte for each sample."""
    body = text + b"\xff" * (max(-(-len(text) // media.UNIT), 1) * media.UNIT - len(text))
    wide = media.WIDTH
    picture = [body[i : i + wide] for i in range(0, len(body), wide)]
    rows, columns = ([n * i // 8 for i in range(8)] + [n] for n in (len(picture), wide))
    means = []
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        for c, d in zip(columns[:-1], columns[1:], strict=True):
            area = [x for line in picture[a : max(b, a + 1)] for x in line[c : max(d, c + 1)]]
            means.append(sum(area) / len(area))
    middle = np.mean(means)
    bits = int("".join("1" if m >= middle else "0" for m in means), 2)
    return f"{wide}x{len(picture)}:{-(-len(picture) // media.FRAME_ROWS)}:{bits:016x}"


def test_media_features_by_loops(spark, docs, rows):
    got = Counter((r["doc_id"], r["feature"]) for r in media.read_features(media.store_texts(docs)).collect())
    assert got == Counter((i, plain_feature((t or "").encode())) for i, t in rows)
    assert len({f for _, f in got}) > 5


def colour_jpeg(dc, width, height):
    """A plain writer of a baseline file with 2 x 2, 1 x 1, 1 x 1 sampling and some AC values, no restart intervals.
    dc: luminance DC values in the order of the scan."""
    lengths = [4] * 9
    counts, order = media._table(lengths)
    code = dict(zip(order, media.canonical(counts), strict=True))
    ac_symbols = [0x00, 0x01, 0x12, 0xF0]
    ac = dict(zip(ac_symbols, media.canonical([0, 0, 4] + [0] * 13), strict=True))
    bits = []

    def put(value, n):
        bits.extend((value >> (n - 1 - i)) & 1 for i in range(n))

    def block(diff, extra):
        c = abs(diff).bit_length()
        put(*code[c])
        put(diff if diff >= 0 else diff + (1 << c) - 1, c) if c else None
        if extra:
            put(*ac[0xF0])
            put(*ac[0x12])
            put(2, 2)
            put(*ac[0x01])
            put(0, 1)
        put(*ac[0x00])

    last, at = 0, 0
    for mcu in range(-(-width // 16) * -(-height // 16)):
        for _ in range(4):
            block(dc[at] - last, at % 3 == 0)
            last, at = dc[at], at + 1
        block(mcu % 5 if mcu == 0 else 0, False)
        block(0, True)
    bits += [1] * (-len(bits) % 8)
    scan = bytes(int("".join(map(str, bits[i : i + 8])), 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    seg = media._segment
    return b"".join(
        [
            b"\xff\xd8", seg(0xE0, b"JFIF\x00"), seg(media.DQT, b"\x00" + bytes([16] * 64)), seg(media.SOF0, struct.pack(">BHHB", 8, height, width, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
            seg(media.DHT, bytes([0x00, *counts, *order])), seg(media.DHT, bytes([0x10, 0, 0, 4] + [0] * 13 + ac_symbols)), seg(media.SOS, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])), scan, b"\xff\xd9",
        ]
    )


def test_decoder_reads_colour_files():
    width, height = 40, 24
    wide, high = 3, 2
    dc = [int(x) for x in np.random.RandomState(3).randint(-50, 50, wide * high * 4)]
    image = media.thumbnails([colour_jpeg(dc, width, height)])[0][0]
    assert image.shape == (3, 5)
    grid = np.array(dc).reshape(high, wide, 2, 2).transpose(0, 2, 1, 3).reshape(high * 2, wide * 2)
    assert (image == np.clip((grid * 16 + 4 >> 3) + 128, 0, 255)[:3, :5]).all()


# 4


def test_token_files(spark, docs, rows, empty, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    files = token_files.write(docs, path, shared_path(spark, "t"), 1)
    got = sorted(files.read(spark, with_ids=True).collect(), key=lambda r: r["start"])
    expected = {}
    for i, text in rows:
        expected.setdefault(i, []).append(library.encode(text or "", add_special_tokens=False).ids + [1])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        ids = list(r["ids"])
        assert ids in expected[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    none = token_files.write(empty, path, shared_path(spark, "t"), 1)
    assert none.read(spark).count() == 0
    monkeypatch.setattr(token_files, "PART_BYTES", 20_000)  # more texts are more files
    more = token_files.write(docs, path, shared_path(spark, "t"), 1)
    assert len(more.parts) > len(files.parts)
    assert sorted(map(tuple, more.read(spark).collect()), key=lambda r: r[1]) == [tuple(r)[:4] for r in got]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("abCDéß ÿÀÞ×'s'td're'll'v\n\t\x0b\x00\x1c\x1f²½01-_.,;<|>İ́"), max_size=30), max_size=6))
def test_parts_encode_as_whole_texts(texts):
    path = tokenizer_path("word_bpe_49k.json")
    encoder = token_files._encoder(path, 1)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    at = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    for i, whole in enumerate(encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == whole.ids + [1]


def test_full_table_keeps_what_is_in_use(monkeypatch):
    monkeypatch.setattr(token_files, "MAX_PARTS", 5)
    encoder = token_files.PartEncoder(tokenizer_path("word_bpe_49k.json"), 1)
    for text in ("the cat sat on the mat again", "the dog ran, ran and ran away", "the cat"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert len(encoder.table.index) < 14


def test_other_tokenizers_encode_whole_texts(spark, docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_files.write(docs, path, shared_path(spark, "t"), 50256).read(spark, with_ids=True)
    expected = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (50256,)) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == expected


def test_long_parts_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "STEP", 1000)
    encoder = token_files.PartEncoder(tokenizer_path("word_bpe_49k.json"), 1)
    for text in ("a" * 2000 + " b", "日" * 700 + " c", "d e"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert max(len(p or b"") for p in encoder.table.index) < 10


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=12), max_size=20))
def test_parts_are_told_apart(texts):
    body = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0] + [len(t) for t in texts])[:-1].astype(np.int64)
    numbers, found = parts.coded(body, starts, len(body))
    assert [found[i] for i in numbers] == texts and len(set(found)) == len(found)
    table = parts.PartTable(np.int32, [7])
    new = [p for p in found if p]
    table.add(new, np.arange(sum(map(len, new))), np.array([len(p) for p in new], np.int64))
    places = lambda t, names: np.array([t.index[p] for p in names], np.int64)
    assert len(table.gather(places(table, texts))) == len(body)
    less = table.for_step(new[::2], 1, 0)
    assert set(less.index) >= {None, b"", *new[::2]} and len(less.index) <= len(table.index)
    assert less.gather(places(less, new[::2])).tolist() == table.gather(places(table, new[::2])).tolist()
    assert less.gather(np.array([0])).tolist() == [7]


# 5


def test_pieces(spark, docs, rows, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    got = pieces.encode(docs, tokenizer_path(PIECES))
    expected = Counter((i, tuple(library.encode(t or ""))) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == expected
    assert got.filter("not parity or not round_trip").count() == 0
    back = pieces.decode(got, tokenizer_path(PIECES))
    assert by_row(back) == Counter((i, t or "") for i, t in rows)
    assert pieces.encode(empty, tokenizer_path(PIECES)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(st.sampled_from("ab ▁.,\n\té'\"(){}0"), max_size=30), max_size=6))
def test_pieces_equal_the_library(texts):
    codec = pieces._codec(tokenizer_path(PIECES))
    ids, agreed = encoded(codec, texts)
    assert agreed.all() and ids == codec.library.encode(texts)
    assert codec.decode([np.array(x, np.int32) for x in ids]) == [codec.library.decode(x) for x in ids]


def encoded(codec, texts):
    flat, counts, agreed, normal = codec.encode(texts)
    assert [a == b for a, b in zip(codec.raw(flat, counts), normal, strict=True)] == [True] * len(texts) or not codec.model.byte_fallback
    return [x.tolist() for x in np.split(flat, np.cumsum(counts))[:-1]], agreed


def field(number, value):
    """A protobuf field: numbers, floats, texts and bytes."""

    def varint(n):
        return bytes([n & 0x7F | 0x80]) + varint(n >> 7) if n > 127 else bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_file(path, byte_fallback, charsmap=b"", user=()):
    """A Unigram model in the format of the library, written by hand: letters, some words, and scores by rank."""
    words = ["▁", *"etaoinshrdlucmfwypvbgkjqxz", "▁the", "▁th", "he", "in", "ing", "▁a", "an", "and", "▁and", "er", "re", "é", "ab", "abc", "▁ab", "bc", "1", "2", "ffi"]
    pieces_ = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((u, 0.0, 4) for u in user)]
    pieces_ += [(f"<0x{n:02X}>", 0.0, 6) for n in range(256 * byte_fallback)]
    pieces_ += [(w, -2.0 - 0.37 * ((n * 7) % 41), 1) for n, w in enumerate(words)]
    body = b"".join(field(1, field(1, p) + field(2, s) + field(3, k)) for p, s, k in pieces_)
    body += field(2, field(3, 1) + field(4, len(pieces_)) + field(35, int(byte_fallback)))
    body += field(3, field(1, "own") + (field(2, charsmap) if charsmap else b"") + field(3, 1) + field(4, 1) + field(5, 1))
    path.write_bytes(body)
    return str(path)


TEXTS = ["the abc and  abcabc in her", "", "  ", "a<s>b </s> x", "<mark>the<mark> <mark>abc", "xyz 12 é\n\tq", "日本 the 日本", "ＡＢＣ the ﬁ ½ ab", "▁the", "a" * 500]


@pytest.mark.parametrize("user", [(), ("<mark>", "bca")])
@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("mapped", [True, False])
def test_unigram_models_equal_the_library(spark, tmp_path, fallback, mapped, user):
    import sentencepiece

    charsmap = b""
    if mapped:
        rules = spm_model._fields(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
        charsmap = dict(spm_model._fields(dict(rules)[3]))[2]
        assert len(charsmap) > 1000
    path = unigram_file(tmp_path / "own.model", fallback, charsmap, user)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = pieces.Codec(path)
    ids, agreed = encoded(codec, TEXTS)
    assert ids == library.encode(TEXTS) and agreed.all(), [t for t, a in zip(TEXTS, agreed, strict=True) if not a]
    got = pieces.encode(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), path)
    assert [r["ids"] for r in got.orderBy("doc_id").collect()] == ids
    assert codec.decode([np.array(x, np.int32) for x in ids]) == [library.decode(x) for x in ids]


def test_own_ids_stand_where_the_library_differs(spark, tmp_path):
    path = unigram_file(tmp_path / "own.model", True)
    texts = ["the <0x41>", "the abc"]
    rows = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).orderBy("doc_id").collect()
    theirs = pieces.Codec(path).library.encode(texts)
    assert [(r["parity"], r["round_trip"], r["ids"] == x) for r, x in zip(rows, theirs, strict=True)] == [(False, False, False), (True, True, True)]


# 8

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def plain_places(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), found


LICENSES = [
    (1, "Released under the MIT License.\nLicensed under CC BY-NC 4.0. under the mit license"),
    (2, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its associated documentation files"),
    (3, "This work is licensed under the GNU General Public License, version 3."),
    (4, "under the MIT licence; apache license 2; by nc"),
    (5, "Licensed under the Apache License, Version 2.0 and cc by nc cc by nc"),
    (6, "é under\tthe\x00mit-license"),
    (9, "\u212aind under the m\u0130t under the mit license"),
    (7, None),
    (8, ""),
    (None, "under the mit license"),
    (1, "Released under the MIT License.\nLicensed under CC BY-NC 4.0. under the mit license"),
    (1, "another text with one id"),
]


def test_licenses(spark, docs, rows, empty):
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in LICENSES], "doc_id long, text string, key int, template string")
    got = licenses.scan(table)
    expected = Counter()
    for i, text in LICENSES:
        n, found = plain_places(text)
        at = [a for a, _ in found]
        expected[i, n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))] += 1
    assert Counter(tuple(r)[:6] for r in got.collect()) == expected
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got.collect()}
    assert labels[2][0] == "mit" and 0.8 <= labels[2][1] < 1
    assert labels[3] == ("gpl-3", 1.0)
    assert all(0 <= s <= 1 for _, s in labels.values())
    assert Counter((r["doc_id"], r["n_words"], r["n_base"]) for r in licenses.scan(docs).collect()) == Counter((i, plain_places(t)[0], 0) for i, t in rows)
    assert licenses.scan(empty).count() == 0


def test_paragraphs_are_found_with_words_put_in_and_left_out(spark):
    """Each paragraph in the middle of other words, with words put in, left out and changed, is found; a third of one is not."""
    long = [(t.split(), label) for t, label in licenses.TEMPLATES if len(t.split()) >= 30]
    rows, expected = [], {}
    for n, (w, label) in enumerate(long):
        edited = ["some", "words", "before"] + w[:10] + ["really"] + w[10:20] + w[21:] + ["and", "after"]
        rows += [(n, " ".join(edited)), (100 + n, " ".join(w[: len(w) // 3]))]
        expected[n] = label
    assert len(long) >= 6
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, label in expected.items():
        assert label in got[n]["labels"].split(",") and 0.8 <= got[n]["score"] <= 1 and got[n]["n_base"] == 0
        assert got[100 + n]["score"] in (0.0, 1.0) or got[100 + n]["score"] >= 0.8


def test_license_scan_has_no_python(spark, docs):
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)
