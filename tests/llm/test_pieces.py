from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from staylens.llm import pieces, queries, tokens

PATH = tokens.public_path(pieces.MODEL)
TEXTS = [
    "", " ", "  ", "a", "Hello, world!", " two  blanks   three ", "line\nbreak\n\n here\r\n\ttab", "\n", "\n\n a", "\n,\n.", "a▁b ▁▁c▁",
    "<s> </s> <unk> <0x0A> <|x|>", "naïve Übergröße, ñandú… 漢字 かな 🙂🙃 é \u0000 \x7f  x y", "don't 'quote' (a).,;:!?---", "aaaaaaaaaaaaaaaaaaaa", "1234567890 12.5% $3",
    "!" * 50, "x" * 5000, "ab" * 3000 + "!" * 900, " " * 700 + "end", "wort\n" * 40, "ﬁ ① ㎒ Å", "﻿bom", "the_snake_case and CamelCase/paths\\here",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("checked", [True, False])
def test_ids_are_those_of_the_library_on_whole_texts(library, checked):
    model = pieces.Pieces(PATH, checked)
    assert model.by_word
    for _ in range(2):
        assert [ids(x) for x in model.encode(TEXTS)] == [library.encode(t) for t in TEXTS]


def test_whole_texts_without_words(library):
    model = pieces.Pieces(PATH)
    model.by_word = False
    assert [ids(x) for x in model.encode(TEXTS)] == [library.encode(t) for t in TEXTS]
    assert not model.words and not model.chunks


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nabeinrst.,!'-0123ÉßÈ漢🙂"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    model = pieces.pieces(PATH)
    assert ids(model.encode([text])[0]) == model.library.encode(text)
    assert model.decode(model.encode([text])) == [model.library.decode(model.library.encode(text))]


def test_both_forms_of_the_agenda_agree():
    model, rng = pieces.pieces(PATH), random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("▁aeinrsthdlougc") for _ in range(rng.randint(1, 60)))
        assert model._short(text) == model._long(text)


def test_equal_scores_merge_the_leftmost_pair():
    model = pieces.Pieces(PATH, checked=False)
    model.rank = {"ab": 0, "bc": 0, "bca": 1}
    for merged in (model._short, model._long):
        assert merged("abcab") == ["ab", "c", "ab"] and merged("bcabc") == ["bc", "ab", "c"]


def test_a_difference_is_an_error():
    model = pieces.Pieces(PATH)
    model.rank = {p: -r for p, r in model.rank.items()}
    with pytest.raises(pieces.MismatchError):
        model.encode(["A plain sentence of several words."])


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr(pieces, "MEMORY", 50)
    model, rng = pieces.Pieces(PATH), random.Random(2)
    for _ in range(20):
        some = [" ".join(f"w{rng.randrange(500)}" for _ in range(30)) for _ in range(5)]
        assert [ids(x) for x in model.encode(some)] == [library.encode(t) for t in some]
        assert len(model.words) <= 50 + 150


def test_rows(spark, library):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[4]), (1, TEXTS[4]), (None, "no id"), (None, None), (99, None)]
    rows.append((100, " ".join(rng.choice(["sun", "moon,", "Stars."]) for _ in range(100_000))))
    docs = documents(spark, rows, "'x' AS ids").repartition(3)
    got = [(r.doc_id, r.ids, r.decoded) for r in pieces.encoded(docs).collect()]
    want = [(i, library.encode(t or "") + [2], library.decode(library.encode(t or "") + [2])) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_round_trip(spark):
    rows = [(i, t.replace("▁", " ")) for i, t in enumerate(TEXTS)]
    back = pieces.decoded(pieces.encoded(documents(spark, rows)).selectExpr("*", "1 AS text"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [1, 2])], "doc_id LONG, ids ARRAY<INT>")
    assert [r.text for r in pieces.decoded(odd).orderBy("doc_id").collect()] == ["", "", ""]


def test_query(spark, library, tmp_path):
    documents(spark, [(1, "Two words.\n"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op12_sentencepiece"](spark, str(tmp_path)).collect()}
    digest = lambda x: sha256(x.encode()).hexdigest()
    known = [*library.encode("Two words.\n"), 2]
    assert got[1].ids_sha256 == digest(" ".join(map(str, known))) and got[1].n_tokens == len(known)
    assert got[1].decoded_sha256 == digest("Two words.\n") and (got[2].ids_sha256, got[2].decoded_sha256) == (digest("2"), digest(""))


def test_empty_table(spark):
    assert pieces.encoded(documents(spark, [])).collect() == []
