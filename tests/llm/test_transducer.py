"""The BPE transducer against the library that owns the file format."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import transducer

PATH = transducer.default_tokenizer()


@pytest.fixture(scope="module")
def codec():
    return transducer.codec_for(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@given(st.one_of(st.text(max_size=60), st.text("ab 's\n\t<|endofx>é日", max_size=80)))
@settings(max_examples=300, deadline=None)
def test_any_text(codec, library, text):
    assert codec.digests(text) == expected(library, text)
    assert [i for block in codec.encode(text) for i in block] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "",
        " ",
        "<|endoftext|>",
        "a <|endoftext|> b<|endoftext|><|endoftext|>\n ",
        "don't we'll I'M  two   spaces \n\n\t end ",
        "".join(chr(c) for c in range(0x550, 0x5A0)),
        " ".join(f"a{chr(c)}1{chr(c)}!{chr(c)}" for c in (0x558, 0x88F, 0x208F, 0xA7CE, 0x10940, 0x3FC3F, 0x85, 0xA0, 0x1C, 0x3000)),
    ],
)
def test_texts(codec, library, text):
    assert codec.digests(text) == expected(library, text)


@pytest.mark.parametrize("text", ["a" * 60_000, "-" * 50_000, "é" * 30_000, " " * 50_000, "guaranteeing" * 6_000, "日本語" * 20_000, "x y " * 90_000])
def test_long_texts(codec, library, text):
    assert codec.digests(text) == expected(library, text)


def test_stream_of_any_parts_holds_little(codec):
    rng = random.Random(1)
    merges = codec.merges
    for _ in range(60):
        data = bytes(rng.choice(b"abcdeginrtu -=") for _ in range(rng.randint(1, 3000)))
        fed = [0]

        def parts():
            at = 0
            while at < len(data):
                size = rng.choice([1, 7, 100, 400])
                fed[0] = min(len(data), at + size)
                yield data[at : at + size]
                at += size

        ids, size = [], 0
        for block in merges.stream(parts()):
            ids += block
            size += sum(len(merges.bytes_of[i]) for i in block)
            assert fed[0] == len(data) or fed[0] - size <= merges.lookahead + 400 + 128
        assert ids == merges.merge(data) and size == len(data)


def small_file(folder, merges):
    letters = {b: c for c, b in transducer.byte_letters().items()}
    vocab = {letters[b]: b for b in range(256)}
    for left, right in merges:
        vocab.setdefault(left + right, len(vocab))
    path = folder / "small.json"
    model = {"type": "BPE", "vocab": vocab, "merges": [list(m) for m in merges]}
    path.write_text(json.dumps({"model": model, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}))
    return str(path)


def test_lookahead_suffices(tmp_path):
    rng = random.Random(4)
    for _ in range(30):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 12)):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair not in merges and len(pair[0] + pair[1]) <= 6:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        found = transducer.MergeList(small_file(tmp_path, merges))
        for _ in range(60):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            more = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 20)))
            ends = lambda ids: [sum(len(found.bytes_of[i]) for i in ids[: k + 1]) for k in range(len(ids))]
            stable = len(text) - found.lookahead
            assert [e for e in ends(found.merge(text)) if e <= stable] == [e for e in ends(found.merge(text + more)) if e <= stable]
            assert found._merge_many(list(text)) == found._merge_few(list(text))


def test_list_without_bound_is_refused(tmp_path):
    with pytest.raises(ValueError):
        transducer.MergeList(small_file(tmp_path, [("ab", "c"), ("a", "b")]))


def test_decoding_broken_bytes(codec, library):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.randrange(50257) if rng.random() < 0.3 else rng.randrange(90, 300) for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode([10**8, 64]) == "a"


def test_tables(spark, library):
    rows = [(1, "One two  three", "x"), (None, None, "x"), (None, "", None), (1, "One two  three", "y"), (2, "é" * 5000 + "<|endoftext|>", "x")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, `n.ids` string").repartition(3)
    got = sorted(map(repr, map(tuple, transducer.query(table).collect())))
    assert got == sorted(repr((i, *expected(library, t or ""))) for i, t, _ in rows)
    encoded = transducer.encode_documents(table, PATH)
    assert sorted(repr((r["doc_id"], r["ids"])) for r in encoded.collect()) == sorted(repr((i, library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    back = transducer.decode_documents(encoded, PATH).collect()
    assert sorted(repr(tuple(r)) for r in back) == sorted(repr((i, t or "")) for i, t, _ in rows)
    assert transducer.query(table.limit(0)).count() == 0 and transducer.decode_documents(encoded.limit(0), PATH).count() == 0


def test_changed_settings_keep_results(monkeypatch, library):
    monkeypatch.setattr(transducer, "KEPT", 3)
    monkeypatch.setattr(transducer, "SHORT", 2)
    monkeypatch.setattr(transducer, "SPLIT", 8)
    codec = transducer.Codec(PATH)
    for text in ("a bb cc dd ee ff a bb", "The quick  brown\n\nfox's 12345 jumps", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa b"):
        assert codec.digests(text) == expected(library, text)
