"""Encoders against the libraries whose ids they must give, files against what was written."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from sparkeval.llm import bpe, token_files
from sparkeval.llm.elias_fano import EliasFano

RANKS = bpe.load_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [None, "", " ", "a", "\n\n  x", "it's I'LL  we've", "é漢字🙂‍", "a" * 5000, "ab" * 3000, "tail  ", " 12 3.5!!\t\r\n", "\x85x　y"]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = list("ab cd  \n\t'sé漢🙂 0 1.!\r\x0b\x85　 're")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test__merge_trees_equal_the_library():
    coder = bpe.Encoder(RANKS, P.PATTERN)
    texts = random_texts(1500, 3) + [t or "" for t in ODD]
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test__tree_and_forest_agree():
    rng = random.Random(5)
    words = ["".join(rng.choice("thenrsaoi é") for _ in range(rng.randint(1, 60))).encode() for _ in range(300)]
    tree, forest = bpe.MergeTree(RANKS), bpe.MergeForest(RANKS)
    for word in words:
        assert np.frombuffer(forest.pieces([word])[0], "<u4").tolist() == tree.piece(word)


def test__encode_documents(spark, docs):
    table = docs([(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "no id")], extra=("ids", "_ids"))
    out = bpe.encode_documents(table, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert out.columns == [*table.columns, "__ids", "n_tokens", "decoded"]
    rows = out.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        want = LIBRARY.encode_ordinary(r.text or "")
        assert np.frombuffer(r["__ids"], "<u4").tolist() == want and r.n_tokens == len(want) and bytes(r.decoded) == (r.text or "").encode()
    digest = {r.doc_id: r for r in bpe.digests(docs([(1, "the end")]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}[1]
    assert digest.ids_sha256 == hashlib.sha256(np.asarray(LIBRARY.encode_ordinary("the end"), "<u4").tobytes()).hexdigest()
    assert bpe.digests(docs([]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test__elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 2), (1000, 10), (3000, 10**12), (2000, 1)):
        values = np.sort(rng.integers(0, top, n))
        own, size = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
        assert size == len(EliasFano.of(values).to_bytes())
        assert (own[np.arange(n)] == values).all()
        some = rng.integers(0, n, 50)
        assert (own[some] == values[some]).all()
    spread = np.cumsum(rng.integers(0, 2000, 4000))
    assert len(EliasFano.of(spread).to_bytes()) < 8 * 4000 / 3


def test__token_files(spark, docs, tmp_path):
    rows = [(7 - i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "repeated"), (3, "repeated"), (2**40, "far")]
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_tokens(docs(rows, extra=("start", "ids")).repartition(3), P.path("byte_bpe_50k.json"), folder, shard_bytes=4000)
    got = token_files.read_tokens(manifest, documents=3, ids=True).orderBy("start").collect()
    model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (key, text) in zip(got, want, strict=True):
        ids = np.asarray([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        assert bytes(r.ids) == ids.tobytes()
        start += len(ids)
    empty = token_files.write_tokens(docs([]), P.path("byte_bpe_50k.json"), f"{folder}-empty")
    assert token_files.read_tokens(empty).count() == 0
