from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import sentencepiece
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staylens.llm import align

PATHS = align._paths(None, None)
TEXTS = [
    "", " ", "a", "Hello, world! It's a test.", "tokenization of uncommon words: Übergröße, ñandú…", "line\nbreak\n\n here\r\n\ttab;\r x", "a▁b",
    "x<|endoftext|>y <s> </s> <0x0A>", "漢字 かな 🙂🙃 é \u0000 z", "don't 'quote' (a).,;:!?---", "a" * 50, "  two   blanks ", "\n", "12345.678%", "ab12 " * 30,
    "x y 　z w", "\t\tindent", "trailing \r\n \t",
]


class Whole:
    """Both libraries on whole texts, ends compared one by one."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        names = {chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        rest = iter(range(256, 400))
        self.bytes = {c: ord(c) for c in names} | {chr(next(rest)): b for b in range(256) if chr(b) not in names}

    def sides(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        spelt = [bytes(self.bytes[c] for c in self.a.id_to_token(i)) for i in a]
        b = self.b.encode(text)
        pieces = [self.b.id_to_piece(i) for i in b]
        said = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        return a, spelt, b, said

    def groups(self, text):
        if not text:
            return None
        a, bytes_a, b, bytes_b = self.sides(text)
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return None
        found, x, y, at_x, at_y = [], [], [], 0, 0
        left = iter(zip(b, bytes_b, strict=True))
        for i, raw in zip(a, bytes_a, strict=True):
            x, at_x = [*x, i], at_x + len(raw)
            while at_y < at_x:
                j, raw_b = next(left)
                y, at_y = [*y, j], at_y + len(raw_b)
            if at_x == at_y:
                found.append((x, y))
                x, y = [], []
        return found


@pytest.fixture(scope="module")
def whole():
    return Whole()


def brute(whole, rows):
    known = [whole.groups(t) for _, t in rows]
    linked = [Counter((i, j) for x, y in g or () for i in x for j in y) for g in known]
    counts = Counter(p for c in linked for p in c)
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for (doc, _), found, links in zip(rows, known, linked, strict=True):
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in found or ())
        yield (
            doc, sum(len(x) for x, _ in found or ()), sum(len(y) for _, y in found or ()), len(found or ()), links.total(),
            sum(n for p, n in links.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in links.items()),
            sha256(said.encode()).hexdigest() if said else "",
        )


def written(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or ())


def test_slices():
    size = [0, 1, 2, 3]
    assert list(align.slices([1, 2, 3], [3, 1, 2], size, size)) == [([1, 2], [3]), ([3], [1, 2])]
    assert list(align.slices([3], [1, 1, 1], size, size)) == [([3], [1, 1, 1])]
    assert list(align.slices([], [], size, size)) == []


def test_groups_are_those_of_whole_texts(whole):
    side = align.Aligner(*PATHS)
    for _ in range(2):
        for text, found in zip(TEXTS, side.align(TEXTS), strict=True):
            assert found[2] == written(whole.groups(text)), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\r\t abeinrst.,!'-0123ÉßÈ漢🙂;{"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text(whole, text):
    assert align.aligner(*PATHS).align([text])[0][2] == written(whole.groups(text))


def test_memory_is_bounded(whole, monkeypatch):
    monkeypatch.setattr(align, "MEMORY", 30)
    side, rng = align.Aligner(*PATHS), random.Random(2)
    for _ in range(10):
        some = [" ".join(f"w{rng.randrange(300)}." for _ in range(20)) for _ in range(5)]
        assert [x[2] for x in side.align(some)] == [written(whole.groups(t)) for t in some]
        assert len(side.words) <= 30 + 200


@pytest.mark.parametrize("block_links", [1, 100, 10**6])
def test_statistics_match_brute_force(spark, whole, block_links):
    rng = random.Random(4)
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3])] * 4 + [(None, "no id here"), (None, None), (99, None)]
    rows += [(200 + i, " ".join(rng.choice(["sun", "moon,", "Stars.", "tokenizer", "unbelievable"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows.append((300, "very long words " * 20_000))
    docs = documents(spark, rows, "1 AS block").selectExpr("*", "'x' AS pairs", "2 AS place").repartition(5)
    got = align.statistics(docs, block_links=block_links).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, brute(whole, rows)))


def test_aligned_rows(spark, whole):
    rows = [*enumerate(TEXTS), (None, None)]
    got = align.aligned(documents(spark, rows)).collect()
    mine = [(r.doc_id, [(list(g.a), list(g.b)) for g in r.groups]) for r in got]
    assert sorted(map(str, mine)) == sorted(str((i, whole.groups(t) or [])) for i, t in rows)


def test_empty_table(spark):
    assert align.statistics(documents(spark, [])).collect() == []
    assert align.aligned(documents(spark, [])).collect() == []
