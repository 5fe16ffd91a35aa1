"""Operators over documents: brute force, round trips, held-out accuracy, odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagedater.llm import attention, decontaminate, language, packing, quality, secrets, simhash, suffixes
from pagedater.llm.grouping import suffix_array
from pagedater.llm.subword_ids import vocabulary_path

SMALL = "/root/testdata/sf0.001"
GATE = "/root/testdata/sf0.01"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, sequence_id long, fp long, word string, marks string"
)
LONG = "a long line of words " * 20_000


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, null, empty, blank and very long texts, repeated rows, clashing columns."""
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (None, "no id at all"), (None, None), (4, LONG), (5, "same text twice"),
        (5, "same text twice"), (6, "1234 5678"), (7, "token=abcdef1234567 éß中 \U0001f600 x  y\n\nz"), (8, "x" * 5000), (8, "y"),
    ]
    rows = [(i, t, None if i == 2 else "en", None, None, 0.5, 1, 2, "w", "m") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (4, 0, 1), (4, 1, 0), (5, None, None), (None, 1, 0), (6, 1, 0), (7, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, None), (2, ""), (3, "a long line of words a long line of words"), (3, "y"), (None, "no id at all here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(labels, items):
    return {
        "quality": lambda d: quality.classify(d, labels),
        "good": lambda d: quality.good_documents(d, labels),
        "suffixes": suffixes.without_repeats,
        "simhash": simhash.near_duplicates,
        "one_of_each": simhash.one_of_each,
        "language": language.identify,
        "attention": attention.scores,
        "secrets": secrets.secret_report,
        "redact": secrets.redact,
        "packing": packing.packed_documents,
        "occurrences": lambda d: decontaminate.occurrences(d, items),
        "clean": lambda d: decontaminate.clean_documents(d, items),
    }


@pytest.mark.parametrize("name", list(operators(None, None)))
def test_odd_and_empty_input(name, odd, nothing, labels, items):
    operator = operators(labels, items)[name]
    rows = operator(odd).collect()
    assert operator(nothing).collect() == []
    one_to_one = {"quality", "suffixes", "simhash", "language", "attention", "secrets", "redact"}
    if name in one_to_one:
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    if name == "simhash":
        assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"0" * 16}
        assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    if name == "one_of_each":
        assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 4, 5, 6, 7, 8, 8]
    if name == "language":
        assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (1, 2, 3, 6))
    if name == "quality":
        assert all(0 <= r["score"] <= 1 for r in rows)
    if name == "attention":
        assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
        assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    if name == "packing":
        total = {r["doc_id"]: r["doc_tokens"] for r in rows}
        assert total[1] == total[2] == 1 and sum(r["length"] for r in rows if r["doc_id"] == 5) == 2 * total[5]
    if name == "occurrences":
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(4, 3)}
    if name == "redact":
        assert {r["text"] for r in rows if r["doc_id"] in (1, 2)} == {None, ""}
        assert next(r["text"] for r in rows if r["doc_id"] == 7).startswith("[SECRET] é")


def test_suffix_array_is_the_order_of_suffixes():
    draw = random.Random(1)
    for _ in range(500):
        text = [draw.randint(1, draw.choice([1, 2, 4])) for _ in range(draw.randint(0, 50))]
        text = (text[:5] * 12 if draw.random() < 0.3 else text) + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(texts, length):
    data = {k: (t or "").encode() for k, t in texts.items()}
    seen = Counter(b[i : i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out[k] = (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [suffixes.SORTED, 1])
def test_repeats_against_brute_force(spark, monkeypatch, most):
    # With a bound of 1 every group takes the path of hot ones.
    monkeypatch.setattr(suffixes, "SORTED", most)
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghé") for _ in range(6))
    passage = " ".join(word() for _ in range(90))
    texts = {}
    for k in range(60):
        own = [word() for _ in range(draw.randint(0, 150))]
        at = draw.randint(0, len(own))
        start, end = draw.randint(0, 40), draw.randint(400, 700)
        part = passage[start:end]
        if k % 3 == 0:
            place = draw.randint(0, len(part) - 1)
            part = part[:place] + "#" + part[place + 1 :]
        texts[k] = " ".join(own[:at]) + part + " ".join(own[at:]) if k % 5 else " ".join(own)
    texts |= {100: "ab" * 700, 101: texts[1], 102: None, 103: "z" * 399, 104: "z" * 400}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string")
    found = {r[0]: tuple(r[1:]) for r in suffixes.without_repeats(docs).collect()}
    assert found == removed(texts, suffixes.LENGTH)


def brute_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return find


def test_fingerprints_and_components(spark):
    docs = spark.read.parquet(f"{GATE}/documents.parquet")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    ids = sorted(prints)
    value = np.array([prints[i] for i in ids], np.uint64)
    near = [(ids[i], ids[j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(value ^ value[i]) <= 4)]
    find = reach(near)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: (f"{prints[i]:016x}", find(i)) for i in ids}


@pytest.mark.parametrize("paired", [simhash.PAIRED, 2])
def test_links_of_dense_groups(spark, monkeypatch, paired):
    # Beyond the bound groups are linked through variants of the whole word.
    monkeypatch.setattr(simhash, "PAIRED", paired)
    draw = random.Random(5)
    fps = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    value = np.array(fps, np.int64).view(np.uint64)
    expected = reach([(fps[i], fps[j]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(value ^ value[i]) <= 4)])
    made = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in made)
    find = reach([tuple(r) for r in made])
    assert len(made) <= 66 * len(fps) * 2
    assert {x: find(x) for x in fps} == {x: expected(x) for x in fps}


def test_dictionaries_tell_held_out_quality(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, marks).filter("held_out").join(marks, "doc_id").collect()
    right = [r["predicted"] == r["quality"] for r in found]
    kept = [r["predicted"] for r in found if r["quality"] == 1]
    assert np.mean(right) > 0.95 and np.mean(kept) > 0.97


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{GATE}/documents.parquet")
    found = language.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97
    code = language.codewords(4)
    assert np.mean([r["score"] for r in found]) > 0.9
    assert code.shape == (4, 7) and min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) == 4


def test_bits_that_fail_on_texts_left_out_weigh_less():
    draw = random.Random(6)
    # The last two languages use the same letters, some a little more often.
    shares = {"a": ("abcd", (1, 1, 1, 1)), "b": ("wxyz", (1, 1, 1, 1)), "c": ("klmn", (5, 4, 4, 4)), "d": ("klmn", (4, 4, 4, 5))}
    text = lambda lang: "".join(draw.choices(*shares[lang], k=25))
    model = language.train([(lang, text(lang)) for lang in shares for _ in range(60)])
    apart = model.code[2] != model.code[3]
    assert model.languages == list("abcd") and model.bit_weight[apart].max() < 0.7 * model.bit_weight[~apart].min()
    found = [(lang, *model.predict([text(lang)])[0]) for lang in shares for _ in range(60)]
    assert all(lang == to for lang, to, *_ in found if lang in "ab")
    assert all(to in "cd" for lang, to, *_ in found if lang in "cd")
    sure = np.mean([score for lang, _, score, _ in found if lang in "ab"])
    unsure = np.mean([score for lang, _, score, _ in found if lang in "cd"])
    # One scale serves all languages, so this orders sure and unsure texts; it is no calibration of each.
    assert sure > 0.9 and unsure < sure - 0.1
    one = language.train([("a", "abc"), ("a", "abc")])
    assert one.predict(["abc", "1", None]) == [("a", 1.0, False), ("und", 0.0, False), ("und", 0.0, False)]


def test_base_scores_and_model(documents):
    rows = documents.collect()
    words = {r["doc_id"]: [*re.findall(rb"[^\x20\x09-\x0D]+", r["text"].encode().lower()), None] for r in rows}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    total, below = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    found = {r["doc_id"]: r for r in attention.scores(documents).collect()}
    for i, own in words.items():
        row = found[i]
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (row["n_tokens"], row["train_tokens"]) == (len(own), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in own)
        assert row["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.5) / below) for w in own))
        assert row["score"] < 0


def test_held_out_texts_beat_the_base(spark):
    found = attention.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).filter("held_out")
    score, base = found.selectExpr("sum(score)", "sum(base_score)").first()
    assert score > base


def test_windows_score_each_id_once():
    draw = np.random.default_rng(1)
    ids = [np.r_[draw.integers(0, 300, n), attention.END_ID] for n in (0, 1, 23, 24, 25, 44, 45, 300)]
    counts = np.bincount(np.concatenate(ids), minlength=attention.IDS)
    model = attention.fitted(ids, counts, {b"the": 5, b"of": 2}, 1, 3, 20, vocabulary_path(attention.VOCABULARY))
    whole = model.next_logs(ids)
    assert len(whole[0]) == len(whole[1]) == sum(map(len, ids))
    alone = np.concatenate([model.next_logs([t]) for t in ids], axis=1)
    assert np.allclose(whole, alone, atol=1e-5)
    # Probabilities of all ids after one context add up to one, with the end of the word before.
    context = np.full((attention.IDS, attention.WINDOW), attention.END_ID)
    following = context.copy()
    following[:, 0] = np.arange(attention.IDS)
    some = np.concatenate([sum(model.windows(context[i : i + 2000], following[i : i + 2000]))[:, 0] for i in range(0, attention.IDS, 2000)])
    assert np.exp(some.astype(float)).sum() == pytest.approx(1, abs=1e-3)
    # What comes later in a window changes nothing before it.
    changed = ids[-1].copy()
    changed[200:] = 7
    for one, other in zip(model.next_logs([ids[-1]]), model.next_logs([changed])):
        assert np.allclose(one[:200], other[:200], atol=1e-5)
    # Texts scored together get what each gets alone.
    assert np.allclose(model.scores(ids), [model.scores([t])[0] for t in ids], atol=1e-4)


def test_words_of_a_text_add_up_to_one():
    """All words of up to two ids after a text, copies among them, have at most probability one."""
    the, of = (attention.word_encoder(vocabulary_path(attention.VOCABULARY)).encode([[w]])[0] for w in (b"the", b"of"))
    text = np.frombuffer((the + of) * 20, "<u2").astype(np.int64)
    end = np.array([attention.END_ID])
    ids = [np.r_[text, end]] * 3
    counts = np.bincount(np.concatenate(ids), minlength=attention.IDS)
    model = attention.fitted(ids, counts, {b"the": 50, b"of": 20}, 0, 3, 100, vocabulary_path(attention.VOCABULARY))
    assert (attention.earlier(np.array([5, 3, 5, 5, 3], np.uint64)) == [0, 0, 1, 2, 1]).all()
    # An end id after the word makes each score the word's and a certain end's; the word's share is what differs.
    begins = np.flatnonzero(model.starts)
    before = model.scores([text])[0]
    after = np.array(model.scores([np.r_[text, i] for i in begins]))
    # The end of the last word is paid for as soon as a word follows; without it the sum would stay below one too.
    assert 0.3 < (10 ** (after - before)).sum() < 1 + 1e-3


ASSIGN = re.compile(secrets.ASSIGN)


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def written(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secret_spans(spark):
    draw = random.Random(2)
    random_key = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    texts = {
        1: 'secret: token: abcdefgh Api_Key = "abc123" PASSWORD=shorté passwd:=x',
        2: "\U0001f600 AKIA" + "ABCD1234EFGH5678" + " AKIA12 " + "deadbeef" * 4 + " cafe",
        3: "password=" + "ab12" * 8 + " " + "a" * 30 + "1 x",
        4: f"key {random_key} end",
        5: "token=abcdef " * 300,
        6: "".join(draw.choice("token=AKI \nabcdef0123456789:'") for _ in range(3000)),
    }
    texts |= {100 + i: "x " + "".join(draw.choice("ab1") for _ in range(40)) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in secrets.secret_report(docs).collect()}
    for i, text in texts.items():
        base = base_spans(text)
        assert found[i]["base_sha256"] == hashlib.sha256(written(base).encode()).hexdigest()
        assert [found[i][f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(s[1] == k for s in base) for k in range(3)]
        more = [s for s in found[i]["spans"].split(",") if s]
        assert [s for s in more if not s.startswith("random")] == [s for s in written(base).split(",") if s]
    assert found[4]["spans"] == "random:4:44"
    assert not any("random" in found[100 + i]["spans"] for i in range(30))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean[4] == "key [SECRET] end" and clean[5] == "[SECRET] " * 300


def test_redaction_beside_clashing_columns(spark):
    names = ["doc_id", "base", "tried", "counted", "spans", "row", "text", "_words"]
    rows = [(1, "a", "b", 2, [3], {"x": 1}, "é token=abcdef99 end", None), (2, None, None, None, None, None, None, "w")]
    schema = "doc_id long, base string, tried string, counted int, spans array<int>, row map<string,int>, text string, _words string"
    docs = spark.createDataFrame(rows, schema)
    found = secrets.redact(docs)
    assert found.columns == names and found.schema == docs.schema
    clean = {r["doc_id"]: tuple(r) for r in found.collect()}
    assert clean[1] == (*rows[0][:6], "é [SECRET] end", None) and clean[2] == rows[1]
    assert secrets.redact(docs.limit(0)).collect() == []
    long = spark.createDataFrame([(1, ("Q7" * 40_000) + " x" * 40_000), (2, "")], "doc_id long, text string")
    assert {r["spans"] for r in secrets.secret_report(long).collect()} == {""}


def joint_p(token):
    """The battery and Fisher's method in numpy, normal tails from math.erfc."""
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    body = token.rstrip("=")
    letters = min((a for a in secrets.ALPHABETS.values() if set(body) <= set(a)), key=len)
    x, k, n = np.array([letters.index(c) for c in body]), len(letters), len(body)
    cells = max(2, min(k, n // 5))
    held, width = np.bincount(x * cells // k, minlength=cells), np.bincount(np.arange(k) * cells // k, minlength=cells)
    chi = (held**2 * k / width).sum() / n - n
    part = 2 / (9 * (cells - 1))
    zs = [(np.cbrt(max(chi, 0) / (cells - 1)) - 1 + part) / math.sqrt(part)]
    up = x * 2 >= k
    expected = 2 * up.sum() * (n - up.sum()) / n + 1
    turns = 1 + (up[1:] != up[:-1]).sum()
    zs.append(9 if expected <= 2 else abs(turns - expected) / math.sqrt((expected - 1) * (expected - 2) / (n - 1)))
    gap = x - x.mean()
    zs.append(9 if not gap.any() else abs((gap[1:] * gap[:-1]).sum() / (gap**2).sum()) * math.sqrt(n))
    half = -sum(math.log(max(p, 1e-300)) for p in (tail(zs[0]), min(1, 2 * tail(zs[1])), min(1, 2 * tail(zs[2]))))
    return math.exp(-half) * (1 + half + half * half / 2)


def ordinary_p(token, counts):
    """The larger of the p-values by letters of the texts and by published ones."""
    best = 0.0
    for null in (counts, dict(zip("abcdefghijklmnopqrstuvwxyz", secrets.ENGLISH))):
        gap = spread = 0.0
        for kind in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
            q = np.array([null.get(c, 0) + 1 for c in kind]) / sum(null.get(c, 0) + 1 for c in kind)
            s = -np.log(q)
            own = [s[kind.index(c)] for c in token.lower() if c in kind]
            gap += sum(own) - len(own) * (q @ s)
            spread += secrets.SPREAD * len(own) * (q @ (s - q @ s) ** 2)
            if kind[0] == "a":
                all_hex = 1.0 if re.search("[g-z]", token.lower()) else q[:6].sum() ** len(own)
        rare = 0.5 * math.erfc(gap / math.sqrt(2 * spread)) if spread > 1e-9 else 1.0
        best = max(best, min(1.0, rare / (1 - secrets.HEX_SHARE), all_hex / secrets.HEX_SHARE))
    return best


def test_random_strings_among_identifiers(spark):
    draw = random.Random(4)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{GATE}/documents.parquet").collect()}
    words = sorted({w for t in texts.values() for w in re.findall("[a-z]{4,}", t)})
    named, keys = set(), {}
    for i in range(10**7, 10**7 + 900):
        picked = draw.sample(words, 4)
        token = (
            "".join(w.capitalize() for w in picked[:3]) + str(draw.randrange(1000)),
            "_".join(picked),
            "/".join(picked),
        )[i % 3]
        named.add(i)
        texts[i] = f"call {token} now"
    alphabets = [a for a in secrets.ALPHABETS if a not in ("digits", "hex")]
    for i in range(2 * 10**7, 2 * 10**7 + 450):
        letters = secrets.ALPHABETS[alphabets[i % len(alphabets)]]
        keys[i] = "".join(draw.choice(letters) for _ in range((20, 32, 44)[i % 3]))
        texts[i] = f"see {keys[i]} there"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["spans"] for r in secrets.secret_report(docs).collect()}
    assert sum(found[i] == f"random:4:{4 + len(k)}" for i, k in keys.items()) >= 0.9 * len(keys)
    assert sum("random" in found[i] for i in named) <= 0.01 * len(named)

    tried, counts = defaultdict(list), Counter()
    for i, text in texts.items():
        counts.update(c for c in re.sub(secrets.CANDIDATE, " ", text).lower() if c in secrets.COUNTED)
        for m in re.finditer(secrets.CANDIDATE, text):
            tried[(m.end() - m.start()).bit_length()].append((i, m.start(), m.end(), m[0].rstrip("=")))
    expected, near = defaultdict(set), set()
    for band in tried.values():
        ps = np.array([1.0 if joint_p(t) < secrets.STRUCTURED else ordinary_p(t, counts) for *_, t in band])
        edges = 10.0 ** (-np.floor(-np.log10(np.maximum(ps, 1e-300)) * secrets.BINS_PER_TEN) / secrets.BINS_PER_TEN)
        cut = max((e for e in edges if e <= secrets.FALSE_DISCOVERY * (edges <= e).sum() / len(ps)), default=0)
        for (i, start, end, token), p, e in zip(band, ps, edges):
            # The tails in columns are approximate, so values next to a threshold may fall on either side.
            if abs(math.log(joint_p(token) / secrets.STRUCTURED)) < 0.01 or cut and abs(math.log(p / cut)) < 0.3:
                near.add(i)
            if e <= cut and not any(a < end and start < b for a, _, b in base_spans(texts[i])):
                expected[i].add(f"random:{start}:{end}")
    assert len(near) < 0.05 * len(keys)
    for i in set(texts) - near:
        assert {s for s in found[i].split(",") if s.startswith("random")} == expected[i]


def test_pieces_are_the_tokenizers_ids(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.encode_special_tokens = True
    extra = [(5900, "<|endoftext|> it's we'll  ''s\t\t1²½ İǅ ﬁ café\n\n x \n y  z"), (5901, " lead\n trail \n")]
    docs = spark.read.parquet(f"{GATE}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(
        odd.select("doc_id", "text").filter("doc_id in (1, 2, 3, 6, 7)").withColumn("doc_id", F.col("doc_id") + 2000)
    )
    packed = packing.packed_documents(docs, with_ids=True)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["length"], r["ids_crc32"], r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[r["doc_id"]])
        assert np.frombuffer(b"".join(p[1] for p in pieces), "<u4").tolist() == ids
        at = 0
        for start, data, length, crc, total in pieces:
            assert (start, len(data), zlib.crc32(data), len(ids)) == (at, 4 * length, crc, total)
            at += length
    used = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
        used += at
    assert used / (len(by_sequence) * packing.WINDOW) > 0.96


def test_differencing_is_near_equal():
    draw = random.Random(4)
    sizes = [draw.randint(1, 256) for _ in range(400)]
    part = packing.differencing(sizes, 20)
    sums = np.bincount(part, weights=sizes, minlength=20)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= 8


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_leaks_unchanged_and_edited(spark):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(15, 50)))) for k in range(30)]
    docs, planted = [], set()
    for d in range(300):
        words = draw.choices(vocabulary, k=120)
        if d % 2:
            k = draw.randrange(30)
            leak = items[k][1].split()
            for _ in range(int(len(leak) * 0.2) if d % 4 == 1 else 0):
                place = draw.randrange(len(leak))
                change = draw.choice("ird")
                leak[place : place + (change != "i")] = [draw.choice(vocabulary)] if change != "d" else []
            words[60:60] = leak
            if edits(items[k][1].split(), leak) <= int(len(items[k][1].split()) * 0.2):
                planted.add((d, k))
        docs.append((d, " ".join(words)))
    found = decontaminate.occurrences(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    texts, sought = dict(docs), dict(items)
    for r in found:
        got = edits(sought[r["item_id"]].split(), texts[r["doc_id"]][r["start"] : r["end"]].split())
        assert got == r["edits"] <= 0.2 * r["item_words"]
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(planted & pairs) >= 0.97 * len(planted)
    assert {d for d, _ in pairs} <= {d for d, _ in planted}


def test_adjacent_copies_are_all_found():
    """Copies side by side, the last with the fewest edits, and a long text of nothing else."""
    item = "one two three four five six seven eight nine ten".split()
    edited = [w if i != 4 else "x" for i, w in enumerate(item)]
    sought = decontaminate.Items([(7, " ".join(item))])
    found = sought.search(" ".join([*edited, *edited, *edited, *item]))
    assert [f[3] for f in found] == [1, 1, 1, 0]
    assert len(sought.search(" ".join(item * 5000))) == 5000
    assert len(sought.search_all([" ".join(item * 50)], once=True)[0]) == 1


def brute_stretches(item, most, words):
    """Ends at which a stretch of words is within ``most`` edits of the item."""
    row = list(range(len(item) + 1))
    ends = set()
    for j, word in enumerate(words, 1):
        last, row[0] = row[0], 0
        for i, x in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (x != word))
        if row[-1] <= most:
            ends.add(j)
    return ends


def test_stretches_against_all_windows():
    draw = random.Random(12)
    for _ in range(150):
        item = draw.choices("abcd", k=draw.randint(3, 12))
        words = draw.choices("abcd", k=draw.randint(0, 80))
        most = draw.randint(0, len(item) // 4)
        found = list(decontaminate.stretches(item, most, words, 0, len(words)))
        ends = brute_stretches(item, most, words)
        assert all(edits(item, words[s:e]) == n <= most for s, e, n in found)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        # Each stretch that a full scan finds overlaps one that was taken.
        for end in ends:
            start = max(s for s in range(end + 1) if edits(item, words[s:end]) <= most)
            assert any(s < end and start < e for s, e, _ in found)


def test_documents_without_finds_hold_no_stretch(spark):
    """Every given document against every item by a scan of all its words."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    marked = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.occurrences(frame, marked).collect()}
    sought = decontaminate.Items([(r["item_id"], r["text"]) for r in marked.collect()])
    expected = set()
    for doc_id, text in docs:
        words = [sought.vocabulary.get(w, 0) for w in decontaminate.WORD.findall((text or "").lower())]
        for item_id, item, most in sought.items:
            if any(score <= most for _, score in decontaminate.scores(item, words, 0, len(words))):
                expected.add((doc_id, item_id))
    assert found <= expected and len(found) >= 0.99 * len(expected)
