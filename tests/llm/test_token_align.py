"""Token alignment against tables of overlaps made one by one."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cursorlake.llm import token_align
from cursorlake.llm.queries import QUERIES, align_paths
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, odd_rows, prose


@pytest.fixture(scope="module")
def plain():
    """Per text (A ids, B ids, groups, links), by the two libraries and a double loop."""
    left = Tokenizer.from_file(align_paths()[0])
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=align_paths()[1])
    chars = token_align.byte_of_char()

    def of(text):
        if not text:
            return [], [], [], []
        a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        as_bytes = [[bytes(chars[c] for c in left.id_to_token(i)) for i in a],
                    [bytes([int(p[1:-1], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()
                     for i, p in zip(b, right.id_to_piece(b))]]
        if any(b"".join(s) != (" " + text).encode() for s in as_bytes):
            return [], [], [], []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in as_bytes]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for i, e in zip((a, b)[side], ends[side]):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        links, j = [], 0
        for i, e in enumerate(ends[0]):
            s = ends[0][i - 1] if i else 0
            while j < len(b) and ends[1][j] <= s:
                j += 1
            k = j
            while k < len(b) and (ends[1][k - 1] if k else 0) < e:
                links.append((a[i], b[k]))
                k += 1
        return a, b, groups, links

    return of


def expected(plain, rows):
    each = [(i, *plain(t)) for i, t in rows]
    count = collections.Counter(p for *_, links in each for p in links)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, a, b, groups, links in each:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def test_groups_and_overlaps_of_intervals():
    """Intervals with gaps, on both sides, against their graph."""
    r = random.Random(9)
    for _ in range(200):
        sides = []
        for _ in range(2):
            at, side = 0, []
            for _ in range(r.randint(0, 12)):
                at += r.choice([0, 0, 0, 1, 3])
                side.append((at, at + r.randint(1, 4)))
                at = side[-1][1]
            sides.append(np.array(side, np.int64).reshape(-1, 2))
        (a, b), both = sides, np.concatenate(sides)
        links = [(i, j) for i, (p, q) in enumerate(a) for j, (s, t) in enumerate(b) if p < t and s < q]
        i, j = token_align.overlaps(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
        assert list(zip(i.tolist(), j.tolist())) == links
        part = list(range(len(both)))
        for i, j in links * len(both):
            part[i] = part[len(a) + j] = min(part[i], part[len(a) + j])
        got = token_align.groups(both[:, 0], both[:, 1])
        assert len(set(zip(got.tolist(), part))) == len(set(part)) == len(set(got.tolist()))
        order = np.argsort(both[:, 0], kind="stable")
        assert (np.diff(got[order]) >= 0).all()


def test_query_equals_plain_python(spark, plain):
    got = QUERIES["op12_token_alignment"](spark, SF_SMALL)
    texts = spark.read.parquet(SF_SMALL + "/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=str) == expected(plain, texts)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"]


ODD = [(20, "a <|endoftext|> b <s> </s> <unk> <0x41>"), (21, "lower▁bar"), (22, " two  spaces \n\n\t and tabs "),
       (23, "\U0001f469‍\U0001f469 กำ éé ﬁ 　 x"), (24, "x" * 5000 + " " * 3000), (25, "▁")]


@pytest.mark.parametrize("chunk", [1, 200, 1 << 20])
def test_odd_rows(spark, plain, monkeypatch, chunk):
    """One text a chunk, some, and all; equal texts in one and in several chunks."""
    rows = odd_rows() + [(i, t, None, None, None, None, None, None) for i, t in ODD] + [
        (i, prose(i % 3, 25), "en", "s", 1, 0.5, "x", 1) for i in range(30, 45)]
    rows = [(r[0], (r[1] or "")[:20000] or r[1], *r[2:]) for r in rows]
    monkeypatch.setattr(token_align, "CHUNK_BYTES", chunk)
    got = token_align.summaries(docs(spark, rows).coalesce(2), *align_paths())
    assert sorted(map(tuple, got.collect()), key=str) == expected(plain, [r[:2] for r in rows])


def test_alignments_and_empty_table(spark, plain):
    rows = [(i, t, None, None, None, None, None, None) for i, t in ODD]
    for r in token_align.alignments(docs(spark, rows), *align_paths()).collect():
        a, b, groups, _ = plain(dict(ODD)[r.doc_id])
        assert (r.a, r.b) == (a, b)
        assert r.a_group == [n for n, (x, _) in enumerate(groups) for _ in x]
        assert r.b_group == [n for n, (_, y) in enumerate(groups) for _ in y]
    assert token_align.summaries(docs(spark, []), *align_paths()).collect() == []
    assert token_align.alignments(docs(spark, []), *align_paths()).collect() == []


def test_packed_places():
    for top in (0, 1, 2**16 - 1, 2**16, 2**31):
        places = np.random.default_rng(0).integers(0, top + 1, 1000)
        places[:1] = top
        assert token_align.unpacked(token_align.packed(places)).tolist() == places.tolist()
    assert token_align.unpacked(token_align.packed(places[:0])).tolist() == []


def test_other_byte_level_files(tmp_path):
    """A file whose ids are not in merge order is encoded by the tokenizers library."""
    import json
    with open(align_paths()[0], encoding="utf-8") as f:
        spec = json.load(f)
    merges = spec["model"]["merges"]
    spec["model"]["merges"] = merges[:1000][::-1]
    spec["model"]["vocab"] = {t: i for t, i in spec["model"]["vocab"].items() if i < 1256 or i == 50256}
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    text = " the other things that were <|endoftext|> there"
    made = token_align.ByteLevel(str(tmp_path / "t.json"))
    assert b"".join(made.bytes[i] for i in made.encode(text)) == text.encode()
    assert made.encode(text) != token_align.ByteLevel(align_paths()[0]).encode(text)
