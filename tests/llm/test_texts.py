"""Similar documents, repeated lines, toxicity and language-model scores on small texts."""

from __future__ import annotations

import os
import random
import string
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillwright.llm import ngram_trie, queries, toxicity, trie_join
from tillwright.llm.components import components
from tillwright.llm.elias_fano import EliasFano, decode, encode
from tillwright.llm.line_dedup import block_keys, blocks_for, drop_repeated_lines, marked_lines, simhash

SCHEMA = "doc_id long, text string, key int, class string"


def texts_of(seed: int, count: int) -> list[str]:
    """Random texts with copies, near copies, shared passages and short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 900}"
    passage = [word() for _ in range(30)]
    made = []
    for i in range(count):
        words = [word() for _ in range(rng.choice([1, 3, 20, 60, 150]))]
        if i % 5 == 0:
            words += passage
        if i > 10 and i % 3 == 0:
            words = made[rng.randrange(len(made))].split()
            for _ in range(rng.choice([0, 1, 2, 5])):
                if words:
                    words[rng.randrange(len(words))] = word()
        made.append(" ".join(words))
    return made


def brute_components(texts, words, least, scale):
    sets = []
    for text in texts:
        own = (text or "").encode().lower().split()
        sets.append({tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    root = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if scale * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) and sets[i] and sets[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return [len(s) for s in sets], root


@pytest.mark.parametrize(("words", "least", "group"), [(4, 85, 1024), (5, 80, 4), (2, 60, 8)])
def test_similar_documents_equal_brute_force(spark, words, least, group):
    texts = texts_of(3, 140) + ["", None, "  \n ", "One Two", "one\ttwo", "x " * 3000]
    rows = [(i, text, 1, "c") for i, text in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, texts[0], 1, "c"), rows[4]], SCHEMA)
    got = trie_join.similar_documents(df, words, least, 100, group=group).collect()
    sizes, root = brute_components(texts, words, least, 100)
    assert len(got) == len(rows) + 2
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.n_shingles == sizes[0]
        else:
            assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], root[row.doc_id])


def test_one_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words), 0, ""))
    got = trie_join.similar_documents(spark.createDataFrame(rows, SCHEMA), group=32).collect()
    assert {row.component_id for row in got} == {0}


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie_join.similar_documents(empty).collect() == []
    assert drop_repeated_lines(empty).collect() == []


def test_sketches_differ_by_no_more_than_sets():
    rng = np.random.default_rng(5)
    sets = [np.empty(0, np.uint64)]
    for size in (1, 3, 100, 128, 129, 135, 900, 1_030, 20_000, 40_000):
        own = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        near = np.concatenate([own[: -(-size * 9 // 10)], rng.integers(0, 1 << 63, size // 20, dtype=np.uint64)])
        # Buckets of the last one hold more than a byte tells.
        sets += [np.unique(own), np.unique(near), np.unique(own << np.uint64(7))]
    sketches = trie_join.Sketches([trie_join.sketch(s) for s in sets])
    assert len(sketches.levels) > 4
    for i in range(len(sets)):
        others = np.array([j for j in range(len(sets)) if j != i])
        for j, apart in zip(others, sketches.apart(i, others), strict=True):
            assert apart <= len(np.setxor1d(sets[i], sets[j]))
    unlike = sketches.apart(len(sets) - 3, np.array([len(sets) - 6]))
    assert unlike[0] > 20_000


def test_copies_take_the_smallest_id_of_their_component(spark):
    base = [f"w{i}" for i in range(200)]
    near = " ".join([*base[:-1], "other"])
    rows = [(i, " ".join(base)) for i in range(50, 90)] + [(i, near) for i in range(20, 40)]
    rows += [(7, "copied twice and no more"), (9, "Copied twice  and no more"), (9, "Copied twice  and no more")]
    rows += [(5, "alone"), (None, "alone"), (None, " ".join(base)), (3, None), (4, None), (2, ""), (None, None)]
    df = spark.createDataFrame([(*row, 0, "") for row in rows], SCHEMA).repartition(4)
    got = Counter((r.doc_id, r.component_id) for r in trie_join.similar_documents(df).collect())
    expected = Counter({(i, 20): 1 for i in [*range(50, 90), *range(20, 40)]})
    expected += Counter({(7, 7): 1, (9, 7): 2, (5, 5): 1, (None, None): 3, (3, 3): 1, (4, 4): 1, (2, 2): 1})
    assert got == expected


def test_tries_find_what_pairs_find():
    rng = random.Random(1)
    similar = trie_join.Similarity(70, 100)
    for _ in range(30):
        sets = [np.array(sorted(rng.sample(range(40), rng.randrange(1, 25)))) for _ in range(25)]
        links = trie_join.trie_links(sets, list(range(25)), similar)
        root = list(range(25))
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 70 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = root[i], root[j]
                    root = [min(a, b) if r in (a, b) else r for r in root]
        mine = list(range(25))
        for a, b in links:
            x, y = mine[a], mine[b]
            mine = [min(x, y) if r in (x, y) else r for r in mine]
        assert mine == root


@pytest.mark.parametrize("native", [True, False])
def test_components(spark, native):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (7, None)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), native).collect()))
    want = {x: x for a, b in links if None not in (a, b) and a != b for x in (a, b)}
    for _ in range(60):
        for a, b in links:
            if None not in (a, b) and a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), native).collect() == []


def brute_simhash(words):
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("count", [1, 2, 5, 127, 128, 129, 300, 33_000])
def test_simhash(spark, count):
    words = [f"v{i % 50 + i % 7}" for i in range(count)]
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(simhash(F.col("w"))).first()[0] % 2**64 == brute_simhash(words)


@pytest.mark.parametrize("count", [5, 300, 32_767, 40_000])
def test_simhash_by_sums(spark, count):
    words = [f"v{i % 50 + i % 7}" for i in range(count)]
    df = spark.createDataFrame([(1, "\n" + " ".join(words) + ".\nfew words")], "_id long, _text string")
    row = marked_lines(df, 5).select("at._id", "at._at", "size", "bits").collect()
    assert [(r._id, r._at, r.size, r.bits % 2**64) for r in row] == [(1, 1, len(" ".join(words)), brute_simhash(set(words)))]


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_blocks_meet_within_three_bits(spark, blocks):
    rng = random.Random(blocks)
    rows = []
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 3):
            y ^= 1 << bit
        rows.append(tuple(v - 2**64 if v >> 63 else v for v in (x, y)))
    df = spark.createDataFrame(rows, "x long, y long")
    meet = F.arrays_overlap(block_keys(F.col("x"), blocks), block_keys(F.col("y"), blocks))
    assert df.where(~meet).count() == 0
    assert blocks_for(10) == 4 < blocks_for(10**8) < blocks_for(10**13)


def test_repeated_lines(spark):
    long = " ".join(f"word{i}" for i in range(60))
    near = long.replace("word7 ", "wort7 ")
    rows = [
        (1, f"{long}\nonly in the first document here\nshort", 7, "a"),
        (2, f"{long.upper()}!\nonly in the second one of them\nshort", 7, "a"),
        (3, long, 7, "a"),
        (4, "", 7, "a"),
        (5, None, 7, None),
        (None, long, 7, "a"),
        (6, "short\nshort", 7, "a"),
        (7, f"a b c d e f\n{long}\na b c d e f", 7, "a"),
    ]
    got = drop_repeated_lines(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "key", "class"]
    kept = {row.doc_id: row.text for row in got.collect()}
    assert kept == {
        1: rows[0][1], 2: "only in the second one of them\nshort", 4: "", 5: None, None: long,
        6: "short\nshort", 7: "a b c d e f",
    }
    differ = bin(brute_simhash(long.split()) ^ brute_simhash(near.split())).count("1")
    pair = spark.createDataFrame([(1, long, 0, ""), (2, near, 0, "")], SCHEMA)
    assert drop_repeated_lines(pair).count() == (1 if differ <= 3 else 2)


def brute_lines(docs, similarity=0.8):
    """Kept lines by the same definition, all pairs."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    first, lines = {}, defaultdict(list)
    for doc, text in sorted(docs.items()):
        for at, line in enumerate(text.split("\n")):
            norm = " ".join("".join(c for c in line.lower() if c not in string.punctuation).split())
            if len(norm.split(" ")) >= 5:
                lines[norm].append((doc, at))
    names = list(lines)
    root = {n: n for n in names}
    bits = {n: brute_simhash(set(n.split(" "))) for n in names}
    for i, a in enumerate(names):
        for b in names[:i]:
            if bin(bits[a] ^ bits[b]).count("1") <= 3 and distance(a, b) <= 0.2 * max(len(a), len(b)):
                x, y = root[a], root[b]
                root = {n: (x if r == y else r) for n, r in root.items()}
    for n in names:
        first[root[n]] = min([*lines[n], *([first[root[n]]] if root[n] in first else [])])
    gone = {place for n in names for place in lines[n] if place != first[root[n]]}
    return {d: [line for at, line in enumerate(t.split("\n")) if (d, at) not in gone] for d, t in docs.items()}


def test_near_lines_equal_brute_force(spark):
    rng = random.Random(4)
    lines = []
    for _ in range(60):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(4, 60))]
        lines.append(words)
        if rng.random() < 0.5:
            other = list(words)
            other[rng.randrange(len(other))] += rng.choice("abc")
            lines.append(other)
    docs = {i: "\n".join(" ".join(rng.choice(lines)) for _ in range(5)) for i in range(40)}
    df = spark.createDataFrame([(i, t, 0, "") for i, t in docs.items()], SCHEMA)
    got = {row.doc_id: row.text.split("\n") for row in drop_repeated_lines(df).collect()}
    assert got == {d: kept for d, kept in brute_lines(docs).items() if kept}


def changed(words, share, rng):
    """A line with one changed character in a share of its words, at least one."""
    words = list(words)
    for at in rng.sample(range(len(words)), max(1, round(share * len(words)))):
        spot = rng.randrange(len(words[at]))
        words[at] = words[at][:spot] + rng.choice("0123456789") + words[at][spot + 1 :]
    return words


@pytest.mark.parametrize("share", [0, 0.1])
def test_query_finds_near_lines_by_edit_similarity(spark, monkeypatch, share):
    rng = random.Random(6)
    rows = []
    for count in (8, 12, 20, 40, 100):
        for _ in range(40):
            words = ["".join(rng.choices(string.ascii_lowercase, k=rng.randrange(2, 9))) for _ in range(count)]
            rows += [(len(rows) + i, " ".join(w), 0, "") for i, w in enumerate((words, changed(words, share, rng)))]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    got = {row.doc_id for row in queries.op6_line_dedup(spark, "").collect()}
    assert got >= {doc for doc, *_ in rows if doc % 2 == 0}
    # Each pair has an edit similarity above 0.95, so that brute force drops all 200.
    found = sum(doc % 2 and doc not in got for doc, *_ in rows)
    assert found >= 196


def test_query_drops_short_lines_and_lines_without_blanks(spark, monkeypatch):
    han = "".join(chr(0x4E00 + (i * 37) % 900) for i in range(200))
    thai = "".join(chr(0x0E01 + (i * i) % 40) for i in range(12))
    rows = [
        (1, f"Les.\nKeep this\n{han}\n...\n", 0, ""), (2, "les\nkeep that\n...\n", 0, ""), (3, f"own\n{han}", 0, ""),
        (4, han[:90] + "x" + han[91:] + "\nown two", 0, ""), (5, thai, 0, ""), (6, thai[:-1] + "x\nOwn!", 0, ""),
        (7, "Les", 0, ""), (8, " \n\n", 0, ""), (9, "x" * 70_000 + "\nles\nnew", 0, ""), (10, thai, 0, ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    got = {row.doc_id: row.text for row in queries.op6_line_dedup(spark, "").collect()}
    assert got == {
        1: rows[0][1], 2: "keep that\n...\n", 3: "own", 4: "own two", 5: thai, 8: " \n\n", 9: "x" * 70_000 + "\nnew",
    }


def toxic_rows(count, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnst')}" for _ in range(rng.randrange(5, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["vilezz", "Vilezzer", "grukk."])
        rows.append((i, " ".join(words), 0, ""))
    return rows


def test_toxicity_is_learnt_and_held_out_rows_are_not_used(spark):
    rows = toxic_rows(600) + [(1000, "", 0, ""), (1001, None, 0, ""), (None, "x", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = [(i, 1, int(i % 4 == 0), 3) for i in range(600)] + [(None, 1, 1, 1), (5, 1, None, 1), (7, 0, 9, 0)]
    schema = "doc_id long, quality int, toxic int, text int"
    got = toxicity.toxicity_report(docs, spark.createDataFrame(labels, schema)).collect()
    assert len(got) == len(rows)
    held = [row for row in got if row.held_out]
    assert 100 < len(held) < 300
    right = [row.predicted == int(row.doc_id % 4 == 0) for row in held if row.doc_id < 600]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= row.score <= 1 for row in got)
    # Wrong labels of the held-out fold change nothing.
    flipped = [(i, 1, 1 - t if any(i == r.doc_id for r in held) else t, 3) for i, _, t, _ in labels[:600]]
    again = toxicity.toxicity_report(docs, spark.createDataFrame(flipped, schema)).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in got}


@pytest.mark.parametrize("run", ["x" * 100, "x_y-/" * 20, "好" * 100])
def test_toxicity_sees_words_behind_long_runs(run):
    features = toxicity.Features()
    rows = [features.of(text) for text in ["a vilezz b", "a mild b"] * 20]
    weights = toxicity.fit(rows, np.array([1.0, 0.0] * 20))
    toxic, mild = (weights[features.of(run + word)].sum() for word in ("vilezz", "mild"))
    assert toxic > 1 > -1 > mild
    assert all(len(word) <= toxicity.CACHED_LETTERS for word in features.words)


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame(toxic_rows(3), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(row.score < 0.01 for row in toxicity.toxicity_report(docs, none).collect())
    assert toxicity.toxicity_report(docs.limit(0), none).collect() == []


@pytest.mark.parametrize(("count", "universe"), [(0, 9), (1, 1), (900, 1000), (900, 1 << 50), (5000, 1 << 20)])
def test_elias_fano(count, universe):
    rng = np.random.default_rng(count)
    repeated = np.sort(rng.integers(0, universe, count, dtype=np.uint64))
    pointers = EliasFano(np.concatenate(encode(repeated, universe)))
    assert pointers.at(np.arange(count)).tolist() == repeated.tolist()
    keys = np.unique(repeated)
    sequence = EliasFano(np.concatenate(encode(keys, universe)))
    assert list(decode(sequence)) == keys.tolist()
    asked = np.concatenate((keys, rng.integers(0, universe, 1000, dtype=np.uint64)))
    places = {int(k): i for i, k in enumerate(keys)}
    want = np.array([places.get(int(k), -1) for k in asked])
    assert sequence.find(asked).tolist() == want.tolist()
    begins = rng.integers(0, len(keys) + 1, len(asked))
    ends = rng.integers(0, len(keys) + 1, len(asked))
    inside = np.where((begins <= want) & (want < ends), want, -1)
    assert sequence.find_within(asked, begins, ends).tolist() == inside.tolist()


def brute_model(trained, order, discount=0.75):
    """The probability of a token after those before it, with the same one-byte codes."""
    coded = lambda p: 10 ** -(min(255, max(0, round(-log10(p) * 255 / 16))) * 16 / 255)
    single = Counter(token for tokens in trained for token in tokens)
    paths, behind, followers = Counter(), Counter(), Counter()
    for tokens in trained:
        opened = [None, *tokens]
        for size in range(2, order + 1):
            paths.update(tuple(opened[i : i + size]) for i in range(len(opened) - size + 1))
    for path, n in paths.items():
        behind[path[:-1]] += n
        followers[path[:-1]] += 1
    total, size = sum(single.values()), len(single)

    def chance(before, word):
        if not before:
            return max(single[word] - discount, 0) / total + discount * size / total / (size + 1)
        low = chance(before[1:], word)
        if before in behind:
            low *= coded(discount * followers[before] / behind[before])
            if (*before, word) in paths:
                low += coded((paths[*before, word] - discount) / behind[before])
        return low

    return single, total, size, chance


@pytest.mark.parametrize("order", [2, 3, 5])
@pytest.mark.parametrize("hot", [1_000_000, 20])
def test_language_model_equals_brute_force(spark, monkeypatch, hot, order):
    monkeypatch.setattr(ngram_trie, "HOT_CONTEXT", hot)
    texts = [*texts_of(7, 80), "", None, "Ünknown words", "x " * 5000]
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    rows = [(i, t, 0, "") for i, t in enumerate(texts)]
    # A row without an id and a repeated one are scored like others.
    df = spark.createDataFrame([*rows, rows[4], (None, texts[5], 0, "")], SCHEMA)
    layout = ngram_trie.train(spark.createDataFrame(rows, SCHEMA).where("doc_id % 3 <> 0").select("text"), order)
    scored = ngram_trie.score_documents(df, layout).collect()
    assert len(scored) == len(rows) + 2
    single, total, size, chance = brute_model([t for i, t in enumerate(tokens) if i % 3], order)
    for row in scored:
        own = tokens[5 if row.doc_id is None else row.doc_id]
        opened = (None, *own)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(t in single for t in own), total)
        assert row.base_score == pytest.approx(sum(log10((single[t] + 1) / (total + size + 1)) for t in own))
        want = sum(log10(chance(opened[max(0, i - order + 1) : i], opened[i])) for i in range(1, len(opened)))
        assert row.score == pytest.approx(want)


def test_language_model_sums_to_one():
    tokens = [[*t.split(), None] for t in texts_of(8, 30)]
    single, total, size, _ = brute_model(tokens, 2)
    rest = 0.75 * size / total / (size + 1)
    assert sum((n - 0.75) / total + rest for n in single.values()) + rest == pytest.approx(1)


def test_language_model_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b", 0, "")], SCHEMA)
    row = ngram_trie.score_documents(df, ngram_trie.train(df.limit(0).select("text"))).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0, 0)


def test_a_hot_context_has_as_many_files_as_its_tokens_ask_for(spark, monkeypatch):
    monkeypatch.setattr(ngram_trie, "HOT_CONTEXT", 100)
    monkeypatch.setattr(ngram_trie, "BYTES_A_SHARD", 1 << 30)
    text = " ".join(f"x y{i}" for i in range(250))
    layout = ngram_trie.train(spark.createDataFrame([(1, text, 0, "")], SCHEMA).select("text"))
    files = [f for f in os.listdir(layout.place) if f.startswith("paths-")]
    # Three for the 250 followers of x, and one at most for the other words of each shard.
    assert len(files) <= (1 << layout.shard_bits) + 3


def test_sequences_with_long_runs_and_gaps():
    """Runs of ones and of zeros beyond the bits that are read at once."""
    rng = np.random.default_rng(5)
    for scale in (1, 3, 1000):
        steps = np.where(rng.random(3000) < 0.02, rng.integers(0, 2000 * scale, 3000), rng.integers(0, scale, 3000))
        steps[500:900] = 0
        keys = np.cumsum(steps)
        made = EliasFano(np.concatenate(encode(keys.astype(np.uint64), int(keys[-1]) + 1)))
        places = np.arange(len(keys))
        assert (made.at(places) == keys).all()
        here, after = made.pairs_at(places[:-1])
        assert (here == keys[:-1]).all() and (after == keys[1:]).all()
        asked = np.unique(np.concatenate((keys, rng.integers(0, keys[-1] + 50, 3000))))
        found = made.find(asked.astype(np.uint64))
        assert ((found >= 0) == np.isin(asked, keys)).all()
        assert (keys[found[found >= 0]] == asked[found >= 0]).all()
