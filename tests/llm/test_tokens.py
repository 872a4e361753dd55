"""BPE against the tokenizers library, and exact round trips."""

import hashlib
import random
import struct

import numpy as np
import pytest

from lakeingest.llm.bpe import Automaton, Encoder, encode_texts

from .fixtures import documents, rows

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public.path("byte_bpe_50k.json")
CONTENT = open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_rows_match_the_library(spark, library):
    def digest(b):
        return hashlib.sha256(b).hexdigest()
    want = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), digest(struct.pack(f"<{len(ids)}I", *ids)), digest(back.encode()), ids))
    got = [tuple(r) for r in encode_texts(documents(spark), PATH).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    few = [tuple(r) for r in encode_texts(documents(spark), PATH, digests_only=True).collect()]
    assert sorted(few, key=repr) == sorted((w[:4] for w in want), key=repr)
    assert encode_texts(documents(spark, []), PATH).collect() == []


def test_odd_strings_match_the_library(library):
    encoder, rng = Encoder(CONTENT), random.Random(2)
    parts = ["the", "ing", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "\xa0", "é", "ü", "中文", "🙂", "'s", "'ll",
             "'S", "123", "٣", "²", "<|endoftext|>", "<|endo", "$$", "!!", "a", "b", "aa", "​", "﻿", "x" * 70,
             "\U00018e6e", "\U000105c0", "\U00033400", "\x00"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) if rng.random() < 0.8 else chr(rng.randrange(1, 0xD7FF))
                       for _ in range(rng.randrange(25)))
        ids = library.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert list(memoryview(got).cast("I")) == ids
        assert encoder.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_automaton_equals_merging_in_order():
    """On small alphabets with dense merges, the automaton's path is the result of applying the merges by priority."""
    rng = random.Random(4)
    for _ in range(60):
        vocab = {bytes([b]): b for b in range(256)}
        tokens, merges = [b"a", b"b", b"c"], []
        while len(merges) < 12:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in vocab:
                vocab[u + v] = 256 + len(merges)
                merges.append((u, v))
                tokens.append(u + v)
        automaton = Automaton(vocab, merges)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 15)))
            parts = [word[i:i + 1] for i in range(len(word))]
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i:i + 2] = [u + v]
                    i += 1
            assert [automaton.label[t] for t in automaton.encode(word)] == parts
            assert automaton.decode(automaton.encode(word)) == word


def test_words_at_once_equal_one_by_one():
    rng = random.Random(6)
    automaton = Encoder(CONTENT).automaton
    words = ["".join(rng.choice("etaoinsé 中1!") for _ in range(rng.choice([1, 2, 5, 9, 30, 64, 65, 200]))).encode()
             for _ in range(400)]
    assert [list(memoryview(ids).cast("I")) for ids in automaton.encode_words(words)] == list(map(automaton.encode, words))
    assert automaton.encode_words([]) == []


def test_the_arc_table_has_the_arcs_of_the_gadgets():
    """Ranges without an arc against the definition: every pair of tokens of a dense merge list."""
    rng = random.Random(8)
    vocab, merges, tokens = {bytes([b]): b for b in range(256)}, [], [b"a", b"b"]
    while len(merges) < 40:
        u, v = rng.choice(tokens), rng.choice(tokens)
        if u + v not in vocab and len(u + v) < 12:
            vocab[u + v] = 256 + len(merges)
            merges.append((u, v))
            tokens.append(u + v)
    automaton = Automaton(vocab, merges)
    reached = np.array(list(automaton.labels.values()))
    for state in reached:
        got = automaton.has_arcs(np.full(len(reached), state), reached)
        assert got.tolist() == [automaton._arc_now(int(state), int(t)) for t in reached]
