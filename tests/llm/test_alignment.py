import hashlib
import random
from collections import Counter, defaultdict
from functools import cache

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layerworks.llm import alignment
from layerworks.llm.queries import op12_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


@cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return tokenizer, SentencePieceProcessor(model_file=B), letters


def tokens(text):
    """Ids and bytes of both tokenizers, by the libraries alone."""
    tokenizer, pieces, letters = libraries()
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
    b = pieces.encode(text)
    names = [pieces.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
    data = (" " + text).encode()
    return ((a, bytes_a), (b, bytes_b)) if text and b"".join(bytes_a) == data == b"".join(bytes_b) else (([], []), ([], []))


def ends(parts):
    out, at = [], 0
    for part in parts:
        at += len(part)
        out.append(at)
    return out


def brute(rows):
    texts, count = [], Counter()
    for number, text in rows:
        (a, bytes_a), (b, bytes_b) = tokens(text or "")
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        at_b = dict(zip(ends_b, b))
        links = [(i, at_b[e]) for i, e in zip(a, ends_a) if e in at_b]
        shared = sorted(set(ends_a) & set(ends_b))
        groups, begin = [], 0
        for end in shared:
            groups.append(tuple(",".join(str(i) for i, e in zip(ids, es) if begin < e <= end) for ids, es in ((a, ends_a), (b, ends_b))))
            begin = end
        count.update(links)
        texts.append((number, a, b, groups, links))
    highest = defaultdict(int)
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    out = []
    for number, a, b, groups, links in texts:
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
        out.append((number, len(a), len(b), len(groups), len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), digest))
    return sorted(out, key=str)


def got(df):
    names = ["doc_id", *alignment.COUNTS, "groups_sha256"]
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=str)


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a  b\n\nc \t d", "▁x", "naïve café", "日本語のテキスト 東京", "x　y", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "🙂 smile 🙂🙂", "é é", "\x00 nul \x00", "a b", "don't can't we'll", "1234567890 12,345.67", "ﬁ ligature", "ж" * 50, "supercalifragilistic" * 40, "tab\tsep", "trailing  ", "\r\n lines\r\n",
]


@pytest.mark.parametrize("block_bytes", [1, 200, 8 << 20])
def test_odd_texts_equal_brute_force(spark, block_bytes):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, t) for i, t in enumerate(ODD[:12])] + [(None, "a null id"), (None, "a null id"), (7, "again")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(alignment.align(docs, A, B, block_bytes=block_bytes)) == brute(rows)


def test_random_texts_equal_brute_force(spark):
    chance = random.Random(4)
    letters = "aábcdeèfghi jklmnoö pqrs ßtuvwxyz  .,'\"-\n\t0123ABCÑ­\u0085 \x1c\x7fʰжд中🙂▁"
    rows = [(i, "".join(chance.choice(letters) for _ in range(chance.randrange(1, 60)))) for i in range(400)]
    assert got(alignment.align(spark.createDataFrame(rows, SCHEMA), A, B)) == brute(rows)


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").where("length(text) < 4000").collect()]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(alignment.align(docs, A, B)) == brute(rows)
    assert op12_token_alignment(spark, folder).count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_a_very_long_text(spark):
    rows = [(1, "word and more " * 20_000), (2, "unbroken" * 3000), (3, "short")]
    out = {r.doc_id: r for r in alignment.align(spark.createDataFrame(rows, SCHEMA), A, B).collect()}
    assert out[1].n_a == 60_001 and out[1].n_groups >= 60_000
    assert out[2].n_links == out[2].n_groups > 0


def test_counts_of_pairs(spark):
    rows = [(1, "the cat"), (2, "the dog"), (3, "the")]
    blocks = alignment.aligned_blocks(spark.createDataFrame(rows, SCHEMA), A, B)
    counts = {(r.a_id, r.b_id): (r.n, r.best) for r in alignment.link_counts(blocks).collect()}
    the = tokens("the")
    assert counts[the[0][0][0], the[1][0][0]] == (3, True)


def test_windows_are_remembered():
    pair = alignment.Pair(A, B)
    groups, links = pair.aligned(*pair.ids(["one two three one two three one two", "", "two one"]))
    assert len(pair.windows) == 3
    assert [len(x) for x in links] == [g.count("|") for g in groups] == [8, 0, 2]


def test_a_block_remembers_few_windows(monkeypatch):
    """Windows are forgotten within a block too; what it gives stays the same."""
    choice = random.Random(5)
    texts = ["".join(choice.choices("abcdefgh", k=9)) + " unusual " + "".join(choice.choices("stuvwxyz", k=9)) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(400)), "text": texts})
    monkeypatch.setattr(alignment, "TaskContext", type("Context", (), {"get": classmethod(lambda cls: cls()), "partitionId": lambda self: 0}))
    whole = alignment._block(alignment.Pair(A, B), [batch], 0)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 500, raising=False)
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    small = alignment.Pair(A, B)
    assert alignment._block(small, [batch], 0).equals(whole)
    assert len(small.windows) < 150


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    pair = alignment.Pair(A, B)
    plain = alignment.Windows.hashes
    monkeypatch.setattr(alignment.Windows, "hashes", lambda self, salt: plain(self, salt) if salt > 3 else plain(self, 0) * 0)
    assert pair.aligned(*pair.ids(["some words here"]))[0] == alignment.Pair(A, B).aligned(*pair.ids(["some words here"]))[0]


def test_new_windows_of_many_texts_are_aligned_together(monkeypatch):
    calls, plain = [], alignment.Pair.grouped
    monkeypatch.setattr(alignment.Pair, "grouped", lambda self, a, b: calls.append(len(a.sizes)) or plain(self, a, b))
    texts = ["unbelievably Großbritannien's 12345", "naïve  coöperation\n\n日本語 🙂🙂", "x", "unbelievably unbelievably x"]
    pair = alignment.Pair(A, B)
    first = pair.aligned(*pair.ids(texts))
    assert len(calls) == 1 and calls[0] == len(pair.windows) > 4
    again = pair.aligned(*pair.ids(texts[::-1]))
    assert len(calls) == 1 and again[0] == first[0][::-1]
    rows = brute(list(enumerate(texts)))
    assert [hashlib.sha256(g.encode()).hexdigest() for g in first[0]] == [rows[i][-1] for i in range(len(texts))]
    assert [[(x >> 32, x & 0xFFFFFFFF) for x in some.tolist()] for some in first[1]] == [
        [tuple(int(side.split(",")[-1]) for side in group.split("|")) for group in g.split(";")] for g in first[0]
    ]


def test_no_rows_and_clashing_columns(spark):
    empty = alignment.align(spark.createDataFrame([], SCHEMA), A, B)
    assert empty.collect() == []
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    for name in ("id", "block", "links", "count", "best", "n_a", "place", "sizes"):
        docs = docs.withColumn(name, F.lit("x"))
    assert got(alignment.align(docs, A, B)) == brute([(1, "a b")])
