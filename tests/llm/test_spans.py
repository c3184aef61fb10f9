from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from staylens.llm import spans

PASSAGE = "The river rose for three days before the council met again. Nobody had expected spring. Farmers moved their stock to the hills, where the grass had begun to show. They waited. The miller said that he had seen worse, but never in April and never twice. So it was decided."


def brute(rows, least_sentences=3, least_words=20):
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    places = defaultdict(list)
    for d, (_, _, text) in enumerate(docs):
        said, _, sizes = spans.sentences(text)
        n = len(sizes)
        for a in range(n):
            b = next((b for b in range(a + least_sentences, n + 1) if sum(sizes[a:b]) >= least_words), None)
            if b:
                places[tuple(said[a:b])].append((d, a, b))
        for b in range(n, 0, -1):
            a = next((a for a in range(b - least_sentences, -1, -1) if sum(sizes[a:b]) >= least_words), None)
            if a is not None:
                places[tuple(said[a:b])].append((d, a, b))
    gone = defaultdict(set)
    for found in places.values():
        for d, a, b in sorted(set(found))[1:]:
            gone[d].update(range(a, b))
    result = {}
    for d, doc in enumerate(docs):
        _, ends, sizes = spans.sentences(doc[2])
        kept = "".join(doc[2][x:y] for k, (x, y) in enumerate(zip([0, *ends], ends)) if k not in gone[d])
        if ends and len(ends) - 1 in gone[d]:
            kept = kept.rstrip()
        result[doc] = (kept if gone[d] else doc[2], len(ends), len(gone[d]), sum(sizes[k] for k in gone[d]))
    return [(i, *(result[(i is None, i or 0, t)] if t is not None else (None, 0, 0, 0))) for i, t in rows]


def test_sentences_cut_the_whole_text():
    for text in ("", "  a b. c\nd! " + "w " * 25, "x", " \n ", PASSAGE):
        said, ends, sizes = spans.sentences(text)
        assert (ends[-1] if ends else 0) == (len(text) if text.strip() else 0)
        assert sum(sizes) == len(text.split()) and max(sizes, default=0) <= spans.LONGEST
        assert " ".join(said).split() == text.lower().split()


def test_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    stock = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(2, 14))) + rng.choice([". ", "! ", "\n"]) for _ in range(40)]
    rows = [(i, "".join(rng.choice(stock) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    for i in range(40, 60):
        a = rng.randrange(20)
        rows.append((i, "own start of this. " + "".join(stock[a : a + rng.randint(3, 12)]) + f"end {i}"))
    rows += [(3, rows[3][1]), (None, rows[7][1]), (61, None), (62, ""), (63, "".join(stock) * 60)]
    # The first occurrences are chosen by the hash of the text where ids are equal, which the
    # brute force does not know: ids with different texts are left out here.
    got = spans.dedup(documents(spark, rows, "1 AS first").repartition(7)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(rows), key=key)


def test_passage_goes_from_all_but_the_first(spark):
    rows = [(i, f"Document {i} starts in its own way here. {PASSAGE} And {i} ends so.") for i in range(50)]
    rows.append((99, "Nothing here is shared with any other text. It is left alone. Entirely so, from its first word to its last."))
    got = {r.doc_id: r for r in spans.dedup(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1] and got[99].text == rows[-1][1]
    for i in range(1, 50):
        assert got[i].text == f"Document {i} starts in its own way here. And {i} ends so."


def test_empty_table(spark):
    assert spans.dedup(documents(spark, [])).collect() == []


def test_passages_of_51_words_at_every_offset_without_punctuation(spark):
    rng = random.Random(8)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(51)]
    rows = []
    for i in range(40):
        before = [f"b{rng.randrange(10**6)}" for _ in range(i)]
        after = [f"e{rng.randrange(10**6)}" for _ in range(30)]
        rows.append((i, " ".join(before + passage + after)))
    got = {r.doc_id: r for r in spans.dedup(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 40):
        left = set(got[i].text.split())
        assert got[i].removed_words >= 51 - 4 * spans.NEAR + 3
        # Only words of the passage go, and none from its middle stays.
        assert not left & set(passage[2 * spans.NEAR - 1 : 51 - 2 * spans.NEAR + 2])
        assert all(w in left or w in passage for w in rows[i][1].split())


def plain_sentences(text):
    """The cutting rule word by word: sentences, where each ends in the text, and their words."""
    found = list(re.finditer(r"\S+\s*", text))
    words = [m.group().rstrip() for m in found]
    ends = [k for k, m in enumerate(found) if words[k][-1] in ".!?…。" or "\n" in m.group()[len(words[k]) :]]
    if found and (not ends or ends[-1] != len(found) - 1):
        ends.append(len(found) - 1)
    last, start = [], 0
    for end in ends:
        cuts = {end}
        if end - start + 1 > spans.LONGEST:
            key = [zlib.crc32(w.lower().encode("utf-8", "replace")) for w in words]
            for a in range(start, end - spans.NEAR + 2):
                cuts.add(min(range(a, a + spans.NEAR), key=lambda k: (key[k], -k)))
        last += sorted(cuts)
        start = end + 1
    starts = [0, *(k + 1 for k in last[:-1])]
    said = [" ".join(words[a : b + 1]).lower() for a, b in zip(starts, last)]
    return said, [found[k].end() for k in last], [b - a + 1 for a, b in zip(starts, last)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cd", "É", "ΑΣ", "x.", "y!", " ", "  ", "\n", "\t", "\xa0", "\x1c", "　", "。", "İ"]), max_size=80))
def test_cutting_agrees_with_the_rule_word_by_word(parts):
    for text in ("".join(parts), " ".join(parts)):
        assert spans.sentences(text) == plain_sentences(text)


def test_a_very_long_sentence_is_cut():
    rng = random.Random(3)
    text = "\n ".join(" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([3, 30, 4000]))) for _ in range(12))
    assert spans.sentences(text) == plain_sentences(text)
