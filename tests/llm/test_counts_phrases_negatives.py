"""Token counts, collocations and hard negatives against the library and brute force, with
NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from tabulon.llm import collocations, hard_negatives, shingles, token_count

ODD = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "é"), (None, "no id here at all"), (None, None), (5, "x" * 30_000),
       (6, "a\n\nb\n"), (6, "a\n\nb\n"), (7, "Straße ǅ İ"), (8, "  \x85 \xa0 end")]


def frame(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "x", -1, "y") for r in rows],
                                 "doc_id long, text string, lang string, phrase string, n_tokens long, t string")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# ------------------------------------------------------------- 11 token counts

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, lambda t: len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids)


def test_token_counts_are_the_library_s(library):
    path, _ = library
    from tokenizers import Tokenizer

    theirs, own = Tokenizer.from_file(path), token_count.TokenCounter(token_count.read_spec(path), cached=50)
    rnd = random.Random(1)
    parts = ["a", "b", " ", "'s", "'S", "'", "é", "ß", "1", "the", "ing", "!", "\x1c", "\x85", "\xa0", "😀", "ñ", "Σ", "ΑΣ",
             "İ", "中", "é", "​", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "\n", "...", "Ǆ", "K"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts[:rnd.randint(1, len(parts))]) for _ in range(rnd.randint(0, 60)))
        assert own.count(t) == len(theirs.encode(t, add_special_tokens=False).ids)
        assert len(own) <= 50
    for alphabet in ("a", "ab", "thein", "=-", "é", "ha"):
        t = "".join(rnd.choice(alphabet) for _ in range(9000))
        assert own.count(t) == len(theirs.encode(t, add_special_tokens=False).ids)
    for cp in [*range(0x3000), *range(0x1F000, 0x1F700)]:
        t = f"ab{chr(cp)}cd {chr(cp) * 2}1"
        assert own.count(t) == len(theirs.encode(t, add_special_tokens=False).ids), hex(cp)


def test_token_counts_over_rows(spark, library):
    path, theirs = library
    rows = ODD + [(100 + i, "One text, <|endoftext|> again! " * i) for i in range(30)]
    got = token_count.count_tokens(frame(spark, rows), path, keep=("doc_id", "text", "t", "n_tokens")).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "t", "n_bytes", "n_tokens"}
    for r in got:
        assert (r["n_bytes"], r["n_tokens"], r["t"]) == (len((r["text"] or "").encode()), theirs(r["text"]), "y")
    assert token_count.count_tokens(frame(spark, []).limit(0), path).count() == 0


def test_other_tokenizer_files_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_count.read_spec(public_tokenizers.path("byte_bpe_50k.json"))


# ------------------------------------------------------------ 12 collocations

def brute_collocations(rows, least, longest=5, top=2000):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        text = lower(text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang or "und"] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang or "und", tuple(words[i:i + m])] += 1
    cand = {k: a for k, a in counts.items() if 2 <= len(k[1]) <= longest and a >= least}
    inside = set()
    for (lang, words), a in cand.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if a >= counts[lang, words[i:i + m]]:
                    inside.add((lang, words[i:i + m]))
    out = collections.defaultdict(list)
    for (lang, words), a in cand.items():
        if (lang, words) not in inside:
            cuts = [(1000 * a * total[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k)
                    for k in range(1, len(words))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
            for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])}


def phrase_rows(seed, n=400):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "é", "A", "a", "\x01b", "b"]
    phrases = [["new", "york", "city", "hall", "park", "gate"], ["a", "a", "a"], ["of", "the"], ["w1", "w2", "w3"]]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rnd.randint(0, 12)):
            out += rnd.choice(phrases) if rnd.random() < 0.4 else [rnd.choice(words)]
            out.append(rnd.choice(["", "", "", ",", "\n", " \t"]))
        rows.append((i, " ".join(out), rnd.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(r[0], r[1], "en") for r in ODD] + [rows[0]] + [(900 + i, "hot pair " * 300, "hot") for i in range(3)]


@pytest.mark.parametrize("seed,least,ranges,bits,top,together", [
    (1, 10, 500_000, 26, 2000, 1 << 20), (2, 4, 7, 26, 2000, 300), (3, 3, 40, 4, 25, 4000)])
def test_collocations_against_brute_force(spark, monkeypatch, seed, least, ranges, bits, top, together):
    monkeypatch.setattr(collocations, "TOGETHER", together)
    rows = phrase_rows(seed)
    want = brute_collocations([(r[2], r[1]) for r in rows], least, top=top)
    got = collocations.collocations(frame(spark, rows).repartition(5), least=least, range_rows=ranges, bits=bits, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in got.collect()]
    assert set(got) == want and len(got) == len(want) > 20


def test_collocations_of_shorter_phrases_and_of_nothing(spark):
    rows = phrase_rows(4, 100)
    got = {tuple(r) for r in collocations.collocations(frame(spark, rows), least=5, longest=3).collect()}
    assert got == brute_collocations([(r[2], r[1]) for r in rows], 5, longest=3)
    assert collocations.collocations(frame(spark, []).limit(0)).count() == 0
    assert collocations.collocations(frame(spark, ODD), least=3).count() == 0


def test_words_of_one_hash_are_found(spark):
    schema = "t long, lang string, word string, f long"
    assert not collocations.clash(spark.createDataFrame([(1, "en", "a", 1), (2, "en", "b", 1)], schema))
    assert collocations.clash(spark.createDataFrame([(1, "en", "a", 1), (1, "en", "b", 1), (2, "de", "b", 1)], schema))
    part = pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": ["a b a", "a"]})
    zero, one = (collocations.Words(part, seed).t.tolist() for seed in (0, 1))
    assert len(set(zero)) == len(set(one)) == 3 and zero[0] == zero[2] and not set(zero) & set(one)


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000
    row = (1, 2, 0, 0, 0, 2, big, 10 ** 13, big + 1, 0, 0, 0, big + 3, 0, 0, 0, 0)
    names = [*collocations._names(5), "m", "f", "n", "l1", "l2", "l3", "l4", "r1", "r2", "r3", "r4", "ext"]
    df = spark.createDataFrame([row], ", ".join(f"{n} long" for n in names))
    cut = df.select(collocations.best_cut().alias("c")).first()["c"]
    assert cut["score"] == 1000 * big * 10 ** 13 // ((big + 1) * (big + 3)) and cut["k"] == 1


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    data = np.frombuffer(b"ab  Cd e\n" + b"long" * 50 + b" z ab " + b"q" * 33, np.uint8)
    whole = shingles.word_hashes(data)
    monkeypatch.setattr(shingles, "SEGMENT", 16)
    for x, y in zip(whole, shingles.word_hashes(data)):
        assert (x == y).all()
    assert len(whole[0]) == 7 and whole[0][0] == whole[0][5]


# ---------------------------------------------------------- 13 hard negatives

def brute_negatives(rows, every=100, shift=7, labels=10, most=5):
    items = {}
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % shift == 0:
            label = int(math.fmod(label + 1, labels))
        items[i, label, tuple(math.floor(256 * x) for x in v)] = None
    place = lambda i: (i is None, i or 0)
    out = []
    for i, label, v in items:
        if i is None or i % every:
            continue
        score = lambda w: sum(a * b for a, b in itertools.zip_longest(v, w, fillvalue=0))
        others = sorted(((-score(w), place(j), j, k) for j, k, w in items if j != i), key=lambda x: x[:2])
        for s, _, j, _ in [x for x in others if x[3] == label][:most]:
            fits = [x for x in others if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:most]
            out += [(i, j, r + 1, x[2], -s, -x[0]) for r, x in enumerate(fits)]
    return collections.Counter(out)


def vectors(seed, n, dim=8, size=1.0):
    rng, rnd = np.random.default_rng(seed), random.Random(seed)
    centre = rng.normal(size=(3, dim)) * size
    rows = []
    for i in range(n):
        v = [float(np.float32(x)) for x in centre[rnd.randrange(3)] + rng.normal(size=dim) * size * 0.3]
        rows.append((i, v, rnd.choice([0, 1, 2, 9])))
    same = [0.5 * size] * dim
    rows += [(n + i, same, i % 3) for i in range(30)]  # ties
    rows += [(4000, rows[0][1], 0), rows[0], rows[0], (None, same, 1), (None, None, 1), (4001, None, 1), (4002, same, None),
             (4003, [1.0, None], 1), (4004, [float("nan")] * dim, 2), (4005, [float("inf")] * dim, 2), (4100, [], 1),
             (4200, same[:3], 2), (4300, [-x for x in same], 1)]
    return rows


@pytest.mark.parametrize("seed,size,blocks", [(1, 1.0, None), (2, 0.4, (3, 40)), (3, 1e6, (2, 64)), (4, 900.0, (4096, 100))])
def test_hard_negatives_against_brute_force(spark, seed, size, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(hard_negatives, "ANCHORS", blocks[0])
        monkeypatch.setattr(hard_negatives, "CANDIDATES", blocks[1])
    rows = vectors(seed, 250, size=size)
    df = spark.createDataFrame([(*r, 7, "z") for r in rows],
                               "vec_id long, embedding array<float>, label int, id long, bars string")
    got = hard_negatives.hard_negatives(df, anchor_every=20)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives([(i, v and [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows], 20)
    assert collections.Counter(tuple(r) for r in got.collect()) == want and len(want) > 30
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(df.where("vec_id % 20 = 1")).count() == 0


@pytest.mark.parametrize("top", [3, 300, 2 ** 23, 2 ** 40, 10 ** 30])
def test_packed_products_are_exact(top):
    rnd = random.Random(top)
    for n, dim in ((1, 1), (7, 5), (100, 64), (33, 3)):
        a, c = ([[float(rnd.randint(-top, top)) for _ in range(dim)] for _ in range(k)] for k in (9, n))
        a[0], c[0] = [0.0] * dim, [float(-top)] * dim
        x, y = hard_negatives.matrix(a, dim), hard_negatives.matrix(c, dim)
        got = hard_negatives.Packed(y, hard_negatives.norm_bound(x, y)).scores(x)
        want = [[sum(int(p) * int(q) for p, q in zip(r, s)) for s in c] for r in a]
        assert got.tolist() == want
    assert top > 2 ** 20 or hard_negatives.Packed(y, hard_negatives.norm_bound(x, y)).fields > 1
