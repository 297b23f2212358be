"""Languages, collocations and prefix tries against plain loops, on odd rows and on the small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import brute
import pytest
from conftest import SF
from odd_rows import none, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from postroad.llm import collocations, languages, prefix_trie

# ---- languages


def word_likelihood(model, word, lang):
    """log P(word): the product of its bytes' interpolated probabilities."""
    count = lambda key: float(model.counts[key, lang])

    def slot(run):
        key = 0
        for byte in run:
            key = key << 8 | byte
        if len(run) < 3:
            return key + languages.STARTS[len(run) - 1]
        mixed = languages.mixed(languages.np.array([key], languages.np.uint64) * languages._PRIME)[0]
        return int(mixed & languages.np.uint64(languages.SLOTS - 1)) + languages.STARTS[len(run) - 1]

    line, total = b"   " + word + b" ", 0.0
    for at in range(3, len(line)):
        p = (count(slot(line[at : at + 1])) + 0.5) / (float(model.all[lang]) + 128)
        for n in (2, 3, 4):
            of = count(slot(line[at - n + 1 : at]))
            p = (min(count(slot(line[at - n + 1 : at + 1])), of) + languages.BELOW * p) / (of + languages.BELOW)
        total += math.log(p)
    return total


def mixture(model, text):
    """The chosen languages with their proportions, by plain expectation-maximisation."""
    words = collections.Counter(re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()))
    langs = range(len(model.names))
    likely = {w: [word_likelihood(model, w, k) for k in langs] for w in words}
    total = sum(words.values())

    def proportions(chosen):
        share = {k: 1 / len(chosen) for k in chosen}
        for step in range(languages.STEPS + 1):
            sums, value = dict.fromkeys(chosen, 0.0), 0.0
            for w, n in words.items():
                top = max(likely[w][k] for k in chosen)
                parts = {k: share[k] * math.exp(likely[w][k] - top) for k in chosen}
                whole = sum(parts.values())
                value += n * (math.log(whole) + top)
                for k in chosen:
                    sums[k] += n * parts[k] / whole
            if step < languages.STEPS:
                share = {k: v / total for k, v in sums.items()}
        return share, value

    wanted, _ = proportions(list(langs))
    alone = [sum(n * likely[w][k] for w, n in words.items()) for k in langs]
    first = max(langs, key=lambda k: alone[k])
    chosen, share, value = [first], {first: 1.0}, alone[first]
    for k in sorted(langs, key=lambda k: -wanted[k]):
        if k in chosen or wanted[k] * total < 1:
            continue
        found, reached = proportions([*chosen, k])
        if reached <= value + languages.PENALTY * math.log(1 + total):
            break
        chosen, share, value = [*chosen, k], found, reached
    return sorted(((-p, model.names[k]) for k, p in share.items()))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def table(documents):
    return languages.written(languages.learned(documents), "table")


def test_languages_equal_plain_inference(spark, documents, table, odd):
    model = languages.Model.of(table)
    assert model.names == ["de", "en", "es", "fr"]
    texts = [r.text for r in documents.where("n_chars < 1500").limit(12).collect()]
    halves = [a[: len(a) // 2] + " " + b[: len(b) // 2] for a, b in zip(texts, texts[1:], strict=False)]
    df = spark.createDataFrame(list(enumerate(texts + halves)), "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    for rows in (df, odd.where("length(text) < 5000")):
        text_of = collections.defaultdict(list)
        for r in rows.collect():
            text_of[r.doc_id].append(r.text)
        for r in languages.identify(rows, table=table).collect():
            text = text_of[r.doc_id][0] or ""
            if not any(c.isalpha() for c in text):
                assert (r.lang_pred, r.score, r.languages) == ("und", 0.0, [])
                continue
            if len(set(text_of[r.doc_id])) > 1:
                continue
            expected = mixture(model, text)
            assert r.lang_pred == expected[0][1] and r.score == pytest.approx(-expected[0][0], abs=1e-6)
            assert r.languages == [n for _, n in expected] and r.shares == pytest.approx([-p for p, _ in expected], abs=1e-6)


def test_languages_of_held_out_and_mixed_texts(spark, documents, table):
    found = languages.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 30 and sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 < r.score <= 1 for r in found)
    of = collections.defaultdict(list)
    for r in documents.where("n_chars > 600").collect():
        of[r.lang].append(r.text[:600])
    pairs = [(a, b, of[a][k] + "\n" + of[b][k]) for a in of for b in of if a < b for k in range(5)]
    df = spark.createDataFrame([(k, t, None) for k, (_, _, t) in enumerate(pairs)], "doc_id long, text string, lang string")
    right = 0
    for r in languages.identify(df, table=table).collect():
        a, b, _ = pairs[r.doc_id]
        right += set(r.languages) == {a, b} and abs(r.shares[0] - 0.5) < 0.2
    assert right >= 0.9 * len(pairs)


def test_languages_learn_only_from_open_labelled_documents(spark, documents, none):
    open_ = documents.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    blind = documents.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2, F.col("lang")).otherwise("xx"))
    rows = lambda df: sorted(map(tuple, languages.learned(df).collect()))
    assert rows(blind) == rows(open_)
    few = languages.learned(documents, max_per_language=5)
    assert few.agg(F.sum("n")).first()[0] < languages.learned(documents).agg(F.sum("n")).first()[0]
    unlabelled = languages.identify(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unlabelled.collect()} == {("und", 0.0)}
    assert languages.identify(none).count() == 0


# ---- collocations


def best_phrases(docs, min_count=10, longest=3, top=2000):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(brute.LOW)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        rows = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            inside = [f[q] for q in f if len(q) > len(p) and f[q] >= min_count and any(q[j : j + len(p)] == p for j in range(len(q) - len(p) + 1))]
            if any(100 * b >= 50 * a for b in inside):
                continue
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("longest, segment, bits", [(3, 256, 27), (4, 5, 6), (2, 1, 27)])
def test_collocations_equal_plain_counts(spark, odd, longest, segment, bits):
    """Also with segments shorter than most pieces, and a bit map that lets much through."""
    draw = random.Random(3)
    vocabulary = ["a", "b", "c", "Ça", "é", "x" * 300, "z-", " ", "UP", "up"]
    texts = [("".join(draw.choice(vocabulary) + draw.choice([" ", " ", " ", "\t", ", ", "\r\n", "! "]) for _ in range(60)), draw.choice(["l1", "l1", "l1", None, "und"])) for _ in range(40)]
    docs = texts + [(r.text, r.lang) for r in odd.collect()]
    df = spark.createDataFrame([(k, t, x, 1) for k, (t, x) in enumerate(docs)], "code long, text string, lang string, n int").repartition(3)
    expected = best_phrases(docs, longest=longest)
    assert len(expected) > 30
    assert rows_of(collocations.collocations(df, max_words=longest, segment=segment, bits=bits)) == expected


def test_collocations_of_few_and_hot_rows(spark, none):
    assert collocations.collocations(none).count() == 0
    line = spark.range(5000).select(F.lit("a b c").alias("text"), F.lit("en").alias("lang"))
    found = rows_of(collocations.collocations(line))
    assert found == [("en", 1, "a b c", 5000, 5000, 5000, 15000, 1_000_000)]
    short = spark.createDataFrame([("a b", "en")] * 9, "text string, lang string")
    assert collocations.collocations(short).count() == 0
    tops = collocations.collocations(spark.createDataFrame([("a b. c d. e f", "en")] * 12, "text string, lang string"), top=2)
    assert [r[1:3] for r in rows_of(tops)] == [(1, "a b"), (2, "c d")]


def test_scores_beyond_64_bits(spark):
    n = 4_000_000_000
    frequent = {1: spark.createDataFrame([("x", 1, n + 1), ("x", 2, n + 3)], "lang string, w1 long, n long"), 2: spark.createDataFrame([("x", 1, 2, n)], "lang string, w1 long, w2 long, n long")}
    assert collocations._scored(frequent, 2).first().score == 1_000_000 * n * n // ((n + 1) * (n + 3))


def test_words_of_equal_bits_are_found(spark, monkeypatch):
    whole = collocations._codes
    monkeypatch.setattr(collocations, "_codes", lambda words, seed: whole(words, seed) * collocations.np.uint64(seed > 1))
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert {(r.word, r.n) for r in collocations.word_counts(df).collect()} == {("a", 1), ("b", 1), ("c", 1)}
    table, seed = collocations.word_table(df)
    assert seed == 2 and table.select("code").distinct().count() == 3
    with pytest.raises(ValueError):
        collocations.word_table(df, seeds=2)


# ---- prefix tries


def rebuilt_paths(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = [*turns.get(base, [])[:h], *own[h:]]
    return out


def trie_rows(paths):
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = collections.defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(brute.SOLID.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = own + sum(saved[k] for k in kids[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found_rows(nodes):
    return sorted(map(tuple, prefix_trie.report(nodes).collect()), key=str)


def talk(spark):
    """Copies, common beginnings, odd turns, a conversation of 90 turns, negative ids, and columns of clashing names."""
    draw, rows = random.Random(11), []
    roles = ["user", "assistant", None, "ü\u0000"]
    for c in [*range(0, 130), *range(200, 230, 3), -1, -20, -39]:
        n = 90 if c in (40, 41, 47) else draw.randrange(0, 8)
        for t in range(n):
            turn = None if draw.random() < 0.05 else draw.randrange(3) if c % 17 == 3 else t
            text = f"say {t}" if c % 3 else draw.choice(["", None, " \t", "one two  three", "four"])
            rows.append((c, turn, roles[t % 2] if c % 5 else draw.choice(roles), text, c, t))
    rows += [(None, 1, "user", "nobody", 0, 0), (7, 1, "user", "twice", 0, 0), (7, 1, "user", "twice", 0, 0), (300, 0, "user", "w " * 30_000, 0, 0)]
    rows += [(c, t, "user", "same for all", 0, 0) for c in range(1000, 1200) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block long, n long").repartition(5)
    return df, [r[:4] for r in rows]


@pytest.mark.parametrize("block, shards", [(256, None), (3, 7), (1, 2), (40, 40)])
def test_tries_equal_plain_ones(spark, block, shards):
    df, rows = talk(spark)
    paths = rebuilt_paths(rows)
    assert any(not p for p in paths.values()) and max(map(len, paths.values())) >= 89
    found = found_rows(prefix_trie.trie(prefix_trie.rebuilt(df), block, shards))
    assert found == trie_rows(paths)


def test_tries_of_conversations_as_they_are(spark):
    df, rows = talk(spark)
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    expected = trie_rows({c: [t[2:] for t in sorted(v)] for c, v in turns.items()})
    assert found_rows(prefix_trie.trie(prefix_trie.plain(df), shards=9)) == expected
    assert prefix_trie.trie(prefix_trie.rebuilt(df.where("false"))).count() == 0


def test_a_long_conversation_is_numbered_in_parts(spark):
    df = spark.range(6000).select(F.lit(5).cast("long").alias("conv_id"), F.when(F.col("id") > 2500, F.col("id")).alias("turn"), F.lit("user").alias("role"), F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    ranks = prefix_trie.numbered(df, parts=6)
    assert [r.rank for r in ranks.orderBy("rank").collect()] == list(range(1, 6001))


def test_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    state = prefix_trie._Shards(frozenset([b"r"]), 0)
    for c in range(7):
        state.add(0, [b"r"], [0], c, False, None, (0, 0, 0))
    state.close(0)
    pieces = [r for r in state.out if r[0] == 2]
    assert [p[13] for p in pieces] == ["0,1,2", "3,4,5", "6"] and [p[15] for p in pieces] == [0, 1, 2]
