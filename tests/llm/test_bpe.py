import hashlib
import random

import public_tokenizers as P
import tiktoken

from vigia.llm import bpe
from vigia.llm.queries import op1_bpe

from .conftest import ODD_TEXTS, SMALL

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def digest(ids, text):
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_tree_gives_the_library_ids_for_any_leaf():
    random.seed(0)
    parts = ["a", "b", "e", "th", "the ", " ", "é", "ß", "1", "\n", "  ", "!!", "😀", "zz", "\t", "ing", "'s", " "]
    known, ranks = library(), bpe.load_ranks(RANKS)
    for leaf in (1, 3, 24):
        merger = bpe.Merger(ranks, leaf)
        encoder = bpe.TextEncoder(P.PATTERN, lambda piece, m=merger: m.ids(piece.encode()))
        for k in range(600):
            text = "".join(random.choice(parts if k % 2 else "abetho") for _ in range(random.randint(0, 120)))
            assert encoder.ids(text).tolist() == known.encode_ordinary(text)


def test_join_moves_the_seam_as_far_as_needed():
    merger = bpe.Merger(bpe.load_ranks(RANKS))
    for text in (b"a" * 257, b"the" * 90, b"anananananabanana" * 9):
        for at in range(1, len(text), 17):
            assert merger.join(merger.tokens(text[:at]), merger.tokens(text[at:])) == merger.merge(text)


def test_query_equals_library(spark, docs):
    known = library()
    want = {r.doc_id: digest(known.encode_ordinary(r.text or ""), r.text or "") for r in docs.collect()}
    got = op1_bpe(spark, SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_odd_rows_keep_other_columns_and_round_trip(odd):
    out = bpe.decode(bpe.encode(odd, RANKS, P.PATTERN), RANKS).collect()
    assert len(out) == len(ODD_TEXTS) + 2
    for r in out:
        assert bytes(r.decoded).decode() == (r.text or "")
    assert sorted(r.n_words for r in out)[-1] == 2


def test_empty_table_and_clash(odd):
    assert bpe.digests(odd.limit(0), RANKS, P.PATTERN).count() == 0
    try:
        bpe.encode(odd.withColumnRenamed("label", "ids"), RANKS, P.PATTERN)
    except ValueError:
        return
    raise AssertionError("a clashing column must raise")
