"""Token counts, whitening and the manifest against plain computations."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagedater.llm import merkle, token_counts, transducer, whitening
from pagedater.llm.subword_ids import vocabulary_path

GATE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(vocabulary_path(token_counts.VOCABULARY))


def odd_texts(seed=3):
    draw = random.Random(seed)
    bits = ["a", "b", "é", " ", "  ", "\n", "the", " and", "▁", "漢", "字", "😀", "\x00", "ing", "<s>", "</s>", "<0x0A>"]
    mixed = ["".join(draw.choice([*bits, "x" * draw.randint(1, 40), " " * draw.randint(1, 40)]) for _ in range(draw.randint(1, 400))) for _ in range(60)]
    junk = ["".join(draw.choices("0123456789abcdef", k=draw.randint(1, 4000))) for _ in range(8)]
    return ["", " ", "\n", "<s>", "hello world", "a" * 5000, " " * 3000, "=" * 3000, "0" * 4000, *junk, *mixed]


def test_counts_are_the_librarys(spark, model):
    texts = odd_texts()
    docs = spark.read.parquet(f"{GATE}/documents.parquet").select("doc_id", "text")
    extra = [(5000 + i, t) for i, t in enumerate(texts)] + [(None, None), (None, "no id"), (7000, None), (5001, texts[1])]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"n_tokens": F.lit("clash"), "n_bytes": F.lit(-1)})
    found = sorted((tuple(r) for r in token_counts.token_counts(docs).collect()), key=repr)
    expected = []
    for r in docs.collect():
        n = len(model.encode(r["text"] or ""))
        expected.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 4096))
    assert found == sorted(expected, key=repr)
    assert token_counts.token_counts(docs.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [20, 64])
def test_maps_of_chunks_compose_in_any_grouping(counter, model, monkeypatch, chunk):
    """Cuts inside runs that pieces cover: each chunk is a map, composed left to right or in pairs."""
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    monkeypatch.setattr(transducer, "SLACK", 0)
    seen = []
    whole = transducer.scanned

    def both(maps):
        seen.append(len(maps))
        onward = maps[0]
        for m in maps[1:]:
            onward = transducer.composed(onward, m)
        assert whole(list(maps)) == onward
        return onward

    monkeypatch.setattr(transducer, "scanned", both)
    texts = [t for t in odd_texts(5) if t]
    assert counter.counts([transducer.MARK + t for t in texts]) == [len(x) for x in model.encode(texts)]
    assert max(seen) > 50


def test_parts_of_long_texts(counter, model, monkeypatch):
    monkeypatch.setattr(transducer, "PART", 1000)
    text = "some words here " * 2000 + "a" * 9000 + " and the end"
    parts = counter.parts(transducer.MARK + text)
    assert len(parts) > 20 and "".join(parts) == transducer.MARK + text
    assert sum(counter.counts(parts)) == len(model.encode(text))


def test_states_start_anew_when_full(model, monkeypatch):
    monkeypatch.setattr(transducer, "MOST_STATES", 50)
    counter = transducer.Counter(token_counts.piece_scores(vocabulary_path(token_counts.VOCABULARY)))
    texts = odd_texts(9)[:30]
    for text in texts:
        assert counter.counts([transducer.MARK + text if text else ""]) == [len(model.encode(text))]


def brute_whitening(rows, components):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [i for i, _ in kept], deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_against_numpy(spark, monkeypatch):
    draw = random.Random(8)
    common = [0.5, -0.25, 0.125, 1.0, 2.0, -3.0]
    rows = [(i, [draw.gauss(0, 1 + j) for j in range(6)]) for i in range(400)]
    rows += [(1000 + i, common) for i in range(200)] + [(5, rows[5][1]), (None, rows[7][1]), (6, rows[9][1])]
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, []), (2005, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"x": F.lit("clash"), "n": F.lit(0)})
    ids, deviation, white, shares = brute_whitening(rows, 4)
    found = defaultdict(list)
    signs = {}
    out = whitening.whiten(frame, 4).collect()
    assert len(out) == 4 * len(ids)
    brute = defaultdict(list)
    for i, d, w in zip(ids, deviation, white):
        brute[i].append((d, *np.abs(w)))
    for r in out:
        found[r["vec_id"], r["component"]].append((r["deviation"], r["whitened"]))
        assert r["n"] == len(ids) and r["identity_error"] < 1e-8 and np.isclose(r["explained"], shares[r["component"] - 1], rtol=1e-10)
    for (i, c), got in found.items():
        assert np.allclose(sorted((d, abs(w)) for d, w in got), sorted((b[0], b[c]) for b in brute[i]), rtol=1e-8)
    by_id = dict(zip(ids, white))
    for (i, c), got in found.items():
        if i is not None and len(got) == 1 and abs(got[0][1]) > 1e-6:
            signs.setdefault(c, set()).add(np.sign(got[0][1] * by_id[i][c - 1]))
    assert all(len(s) == 1 for s in signs.values())
    monkeypatch.setattr(whitening, "HOT", 1)
    cold = sorted((tuple(r) for r in whitening.whiten(frame, 4).collect()), key=repr)
    assert len(cold) == len(out) and {r[3] for r in cold} == set(deviation)


def test_whitening_weights_and_odd_input(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    counted, once = whitening.whiten(frame).collect(), whitening.whiten(frame, by_counts=False).collect()
    assert {r["n"] for r in counted} == {4} and {r["n"] for r in once} == {2}
    assert {round(abs(r["whitened"]), 6) for r in once} == {1.0}
    assert {round(abs(r["whitened"]), 6) for r in counted} == {round(3**-0.5, 6), round(3**0.5, 6)}
    assert {r["component"] for r in counted} == {1}
    assert whitening.whiten(frame.limit(1)).collect() == [] == whitening.whiten(frame.limit(0)).collect()
    assert whitening.whiten(frame.withColumn("embedding", F.lit(None).cast("array<float>"))).collect() == []
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")).collect()


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def brute_manifest(rows):
    def leaf(row, more=0):
        out = []
        for k in ("doc_id", "source", "lang", "n_chars", "text"):
            v = row[k]
            v = v + more if k == "n_chars" and v is not None else v
            out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
        return H(*out)

    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: brute_levels([r[2] for r in sorted(trees[x], key=lambda r: r[:3])]) for x in names}
    upper = brute_levels([built[x][-1][0] for x in names])
    root, out = upper[-1][0], []
    for at, x in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(trees[x], key=lambda r: r[:3])):
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node, proof = leaf(row, 1) if tampered else own, []
            for levels, i in ((built[x], place), (upper, at)):
                for level in levels[:-1]:
                    j = i ^ 1
                    pair = [node] + ([level[j]] if j < len(level) else [])
                    proof += pair[1:]
                    node, i = H(*(pair if j > i else pair[::-1])), i >> 1
            out.append((row["doc_id"], own, built[x][-1][0], root, H(*proof), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, merkle.HEIGHT])
def test_manifest_against_plain_trees(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    draw = random.Random(4)
    rows = [(i, "t" * (i % 9), draw.choice([None, "en", "fr", "de", "Æ"]), "web", i) for i in range(130)]
    rows += [(200 + i, "x", "en", None, None if i % 2 else 5) for i in range(60)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (3, "", "zh", "s", -1), (7, "same", "en", "s", 1), (7, "same", "en", "s", 1), (7, "other", "en", "s", 1), (8, "long " * 200_000, "", "s", 2**63 - 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.audit(docs.withColumns({"tree": F.lit(1), "digest": F.lit("clash"), "block": F.lit(0)}))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_manifest(docs.collect())


def test_manifest_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r) for r in merkle.audit(docs).collect()] == brute_manifest(docs.collect())
    assert merkle.audit(docs.limit(0)).collect() == []


def test_versions_copy_only_ancestors(spark):
    rows = [(i, "t", "en" if i % 3 else "fr", "s", i) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in merkle.versions(docs, F.col("doc_id") % 5 == 0).collect():
        if r["doc_id"] % 5:
            assert r["copies"] is None and r["verified"]
        else:
            # 30 or 60 leaves, and two subroots.
            assert len(r["copies"]) == (5 if r["doc_id"] % 3 == 0 else 6) + 1
            assert r["copies"][-1] == r["folded_root"] != r["root"]
