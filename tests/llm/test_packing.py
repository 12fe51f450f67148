import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from turnlens.llm.packing import Packer, WordTokens, pack, padded_length

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "Don't stop. It's 12,345.67% of it all!", "a\x1cb\x1dc", "é é ́x İstanbul ΣΑΣ straße", "don't 'twas we'll", "",
    "<|endoftext|> x<|startoftext|>y", "x" * 500, "word. word, WORD! (word) word.. wörd; ªº µ", "日本語 テキスト 👍🏽 a", "ͅ a​b", "...", "ß. ſ. ÿ, Ÿ.",
]


def test_cached_chunks_equal_the_tokenizer(tokenizer):
    tokens = WordTokens(PATH, 1, cache_bytes=5)
    texts = TEXTS * 2 + [" ".join(TEXTS)]
    want = [tokenizer.encode(text, add_special_tokens=False).ids + [1] for text in texts]
    want = [b"".join(i.to_bytes(4, "little") for i in ids) for ids in want]
    assert tokens.encode(texts) == want == [tokens.encode([t])[0] for t in texts]


def check(rows, got, tokenizer, length):
    docs = defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
    for ident, texts in rows.items():
        want = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for t in texts)
        assert sum(r.length for r in docs[ident]) == sum(map(len, want))
        if len(texts) == 1:
            at = 0
            for r in sorted(docs[ident], key=lambda r: r.start):
                ids = b"".join(i.to_bytes(4, "little") for i in want[0][at : at + r.length])
                assert (r.start, r.doc_tokens, zlib.crc32(bytes(r.ids))) == (at, len(want[0]), zlib.crc32(ids))
                at += r.length
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at and size > 0
            at += size
        assert at <= length
    return sequences


def test_every_id_once_and_little_padding(make_docs, odd_rows, prose, tokenizer):
    rows = odd_rows + [(1000 + i, prose(30 + 7 * i % 400, i)) for i in range(60)]
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    got = pack(make_docs(rows, extra=True).repartition(5), PATH, length=256, windows=4, merge=2)
    sequences = check(texts, got.collect(), tokenizer, 256)
    total = sum(size for pieces in sequences.values() for _, size in pieces)
    assert len(sequences) <= total / 256 + 2
    used = {r.sequence_id: (r.used, r.padded) for r in padded_length(got, 256).collect()}
    assert all(padded == (u if u & (u - 1) == 0 else 256) for u, padded in used.values())


def test_best_fit_and_fullest_first():
    packer = Packer(10, 2, 0, 0)
    four = bytes(4)
    for ident, n in enumerate((6, 7, 3)):  # 3 fits best where 7 is
        assert list(packer.add(ident, 0, four * n, n)) == [] or ident == 2
    assert packer.used == [6]
    assert list(packer.add(3, 0, four * 9, 9)) == [] and sorted(packer.used) == [6, 9]
    rows = list(packer.add(4, 0, four * 5, 5))  # none has room: the fullest is topped up
    # The fullest is topped up and emitted; what remains of the document fills the other one.
    assert [(r[0], r[2]) for r in rows] == [(3, 9), (4, 1), (0, 6), (4, 4)] and packer.used == []


def test_empty_table(make_docs):
    assert pack(make_docs([]), PATH).collect() == []


def test_new_chunks_are_encoded_together_and_like_whole_texts(monkeypatch):
    tokens = WordTokens(public_tokenizers.path("word_bpe_49k.json"), 1)
    texts = ["µm ªº K kK Å ÅB Ünï.. a²b x.! it's İ z _a_ ÿ, ×÷ A×B é, É! İI Ǆ ﬁn", "A1 b2 c3! (d) e-f g_h Plain words, here. " + "Z" * 60, ""]
    want = [tokens.ids(t) + tokens.end for t in texts]
    calls = []
    monkeypatch.setattr(tokens, "ids", lambda text: calls.append(text))
    assert tokens.encode(texts) == want and tokens.encode(texts[::-1]) == want[::-1]
    assert not calls
