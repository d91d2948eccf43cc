"""Token alignment, Merkle manifest and license scan against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesloom.llm import license_scan, merkle_manifest, token_alignment
from tests.conftest import DATA

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def rows_of_all(spark, edge_docs, docs):
    """Edge cases with the columns of the documents; some names clash with the operators' own."""
    edge = edge_docs.withColumn("n_chars", F.length("text").cast("long"))
    clashing = ("size", "place", "root", "labels", "block", "segment")
    return edge.select(*docs.columns, *(F.lit("x").alias(c) for c in clashing))


# token alignment


def brute_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a_side.encode_special_tokens = True
    known = token_alignment._byte_level(PATHS[0])[1], token_alignment._pieces(PATHS[1])[1]
    each = []
    for doc_id, text in rows:
        text = text or ""
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        same = [b"".join(k[i] for i in ids) == (" " + text).encode() for k, ids in zip(known, (a, b))]
        if not text or not all(same):
            a, b = [], []
        spans = []
        for ids, k in ((a, known[0]), (b, known[1])):
            ends = np.cumsum([len(k[i]) for i in ids]).astype(int).tolist()
            spans.append(list(zip([0, *ends], ends, ids)))
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if a else []
        shared = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [
            "|".join(",".join(str(i) for s, e, i in side if low <= s and e <= high) for side in spans)
            for low, high in zip([0, *shared], shared)
        ]
        digest = sha256(";".join(groups).encode()).hexdigest() if a else ""
        each.append((doc_id, len(a), len(b), len(groups), links, digest))
    count = Counter(p for *_, links, _ in each for p in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return Counter(
        (i, n_a, n_b, g, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), d)
        for i, n_a, n_b, g, links, d in each
    )


def aligned(table):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return Counter(tuple(r[n] for n in names) for r in token_alignment.align(table, *PATHS).collect())


def test_alignment_equals_brute_force(spark, docs, no_docs, monkeypatch):
    short = docs.filter("length(text) < 1500 or text is null").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(1, " "), (1, "  two  "), (2, "<|endoftext|> <s>"), (3, "ﬁ 漢字 😀 ▁ é"), (4, "\r\n\t"), (None, "same"), (None, "same"), (5, "a\x00b")],
        "doc_id long, text string",
    )
    for table in (short, odd):
        expected = brute_alignment([(r.doc_id, r.text) for r in table.collect()])
        assert aligned(table) == expected
        # many small segments
        with monkeypatch.context() as small:
            small.setattr(token_alignment, "SEGMENT_DOCS", 3)
            assert aligned(table) == expected
    assert token_alignment.align(no_docs, *PATHS).count() == 0


def test_alignment_of_edge_rows(rows_of_all):
    given = Counter(r.doc_id for r in rows_of_all.select("doc_id").collect())
    out = token_alignment.align(rows_of_all, *PATHS).collect()
    assert Counter(r.doc_id for r in out) == given
    by_id = {r.doc_id: r for r in out}
    assert by_id[3].n_a == by_id[4].n_b == 0 and by_id[3].groups_sha256 == ""
    assert by_id[7].n_a > 100_000 and by_id[7].n_best <= by_id[7].n_links


def test_bitmaps_and_planes_round_trip():
    rng = np.random.default_rng(1)
    given, docs, bits, planes = [], [], [], []
    for n in (1, 2, 7, 8, 9, 300, 4096, 1):
        for most in (1, 2, 40):
            places, counts = np.sort(rng.choice(4096, n, replace=False)), rng.integers(1, most + 1, n)
            packed, is_bits = token_alignment.pack_bitmap(places)
            assert len(packed) <= 512
            docs.append(packed)
            bits.append(is_bits)
            planes.append(token_alignment.pack_planes(counts))
            given += [(len(docs) - 1, p, c) for p, c in zip(places.tolist(), counts.tolist())]
    assert set(bits) == {True, False} and b"" in planes
    for skip in (0, 3):
        columns = [pa.array(c).slice(skip) for c in (docs, bits, planes)]
        found = zip(*(x.tolist() for x in token_alignment.unpack_postings(*columns)))
        assert list(found) == [(r - skip, p, c) for r, p, c in given if r >= skip]


def test_postings_are_packed_as_pair_by_pair():
    rng = np.random.default_rng(2)
    runs = [np.sort(rng.choice(4096, n, replace=False)) for n in (1, 2, 7, 8, 9, 300, 4096, 1, 600)]
    docs = np.concatenate(runs)
    starts = np.cumsum([0] + [len(r) for r in runs[:-1]])
    for most in (1, 2, 40):
        counts = rng.integers(1, most + 1, len(docs))
        packed, bits, planes = token_alignment.pack_postings(docs, counts, starts)
        assert list(zip(packed, bits.tolist())) == [token_alignment.pack_bitmap(r) for r in runs]
        assert planes == [token_alignment.pack_planes(counts[s : s + len(r)]) for s, r in zip(starts, runs)]


def test_repeated_words_are_encoded_once_by_both_vocabularies(monkeypatch):
    import sentencepiece

    texts = ["one two two one", "one, two\nthree </s> \x00 one", "caf\u00e9 one", "x" * 50 + " two", "a  b", " a", "a ", "", " ", "two \ufb01 \u0301x"]
    encode = token_alignment._Pieces(PATHS[1])
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    level = token_alignment._ByteLevel(PATHS[0])
    for limit in (1_000_000, 5):
        monkeypatch.setattr(token_alignment, "CACHE_CHARS", limit)
        for some in (texts, texts[::-1], texts[:1]):
            assert [ids.tolist() for ids in encode(some)] == model.encode(some)
            assert [ids.tolist() for ids in level(some)] == level._encoded(some)
    monkeypatch.setattr(token_alignment, "CACHE_CHARS", 1_000_000)
    encode, asked = token_alignment._Pieces(PATHS[1]), []
    inner = encode._of_words._encode
    encode._of_words._encode = lambda words: asked.extend(words) or inner(words)
    encode(texts[:4])
    encode(texts[:4])
    # too long a word is not kept
    assert asked.count("one") == asked.count("two") == 1 and asked.count("x" * 50) == 2


# Merkle manifest


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """Root and the siblings of each leaf with their places, by levels over the whole tree."""
    paths = [[] for _ in leaves]
    nodes, under = list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        up, up_under = [], []
        for s in range(0, len(nodes), 3):
            run = nodes[s : s + 3]
            for j in range(len(run)):
                for leaf in under[s + j]:
                    paths[leaf].append((j, run[:j] + run[j + 1 :]))
            up.append(digest(run))
            up_under.append(sum(under[s : s + 3], []))
        nodes, under = up, up_under
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(r, text):
        return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text))

    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    root, tops = brute_tree([trees[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, tops):
        for (_, _, own, r), path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1]):
            tampers = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = leaf(r, r.text.replace("\n", "")) if tampers else own
            for place, others in path + top:
                node = digest([*others[:place], node, *others[place:]])
            proof = digest(x for _, others in path + top for x in others)
            out[(r.doc_id, own, trees[s][0], root, proof, node, node == root)] += 1
    return out


def test_manifest_equals_brute_force(docs, rows_of_all, no_docs, monkeypatch):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    for table, depths in ((rows_of_all, (7, 1)), (docs, (2,))):
        expected = brute_manifest(table.collect())
        for levels in depths:
            monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", levels)
            monkeypatch.setattr(merkle_manifest, "BLOCK", 3**levels)
            out = merkle_manifest.tamper_report(table).collect()
            assert Counter(tuple(r[n] for n in names) for r in out) == expected
    verified = {r.doc_id: r.verified for r in out}
    assert set(verified.values()) == {True, False}
    assert merkle_manifest.tamper_report(no_docs.withColumn("n_chars", F.lit(1))).count() == 0
    one = docs.limit(1).cache()
    (only,) = merkle_manifest.tamper_report(one).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == sha256(b"").hexdigest()


def test_open_block_extends_earlier_witnesses():
    for size in range(1, 30):
        leaves = [digest([str(i)]) for i in range(size)]
        block = merkle_manifest.OpenBlock(merkle_manifest.levels_of(size))
        for leaf in leaves:
            block.append(leaf)
        root, paths = brute_tree(leaves)
        assert block.finish() == root
        assert [merkle_manifest.witness_levels(bytes(w)) for w in block.witnesses] == paths


# license scan


def test_license_blocks_equal_brute_force(spark, docs, no_docs):
    templates = [*license_scan.TEMPLATES, ("the the of", "short"), ("alpha beta gamma delta epsilon", "greek"), ("", "none")]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [
        (-1, "x " * 37 + "Licensed  under the Apache-License; version 2.0 " + "y " * 11),
        (-2, "epsilon delta gamma. ALPHA-beta " * 3),
        (-3, "K alpha beta gamma delta epsilŏn"),
        (-4, None),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (Fraction(9, 10), Fraction(1, 2), Fraction(1)):
        expected = Counter()
        for doc_id, text in rows:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(license_scan.LOWER))
            for wording, label in templates:
                own = set(wording.split())
                stride = len(wording.split())
                for start in range(0, len(words), stride) if own else ():
                    block = words[start : start + 2 * stride]
                    if len(own & set(block)) >= threshold * len(own):
                        expected[(doc_id, label, wording, start, start + len(block), len(own & set(block)) / len(own))] += 1
        out = license_scan.license_blocks(table, templates, threshold).collect()
        assert Counter(tuple(r) for r in out) == expected and expected


def test_license_report_of_edge_rows(spark, rows_of_all, no_docs):
    out = license_scan.scan(rows_of_all)
    assert set(rows_of_all.columns) - {"text"} < set(out.columns)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in rows_of_all.collect())
    assert license_scan.license_report(no_docs).count() == 0
    texts = ["All rights reserved all rights\nreserved", "CC-BY cc\tby", "Released under the MIT License.", None, "", "cc"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.license_report(table).collect()}
    assert [found[i].n_base for i in range(6)] == [2, 2, 0, 0, 0, 0]
    assert (found[0].first_word, found[0].last_word, found[0].base_labels, found[0].score) == (0, 3, "reserved", 1.0)
    assert (found[2].labels, found[2].base_labels, found[2].score, found[2].first_word) == ("mit", "", 1.0, None)
    assert found[3].labels == "" and found[3].n_words == found[4].n_words == 0


def test_too_many_template_words_are_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(license_scan, "MOST_TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError, match="words"):
        license_scan.license_report(docs)


def test_words_met_again_stay_when_room_is_made(monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHE_CHARS", 40)
    asked = []

    def encode(words):
        asked.extend(words)
        return [[len(w), ord(w[-1])] for w in words]

    known = token_alignment._Words(encode)
    for k in range(40):
        lists = [["often", f"rare{k}", "often"], [], ["y" * 50, "often"]]
        out = known(lists)
        assert [x.tolist() for x in out] == [[i for w in words for i in (len(w), ord(w[-1]))] for words in lists]
    assert asked.count("often") == 1 and known([]) == []
    assert known._held <= 2 * 40
