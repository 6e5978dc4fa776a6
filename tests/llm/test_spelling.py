import random
import re
import zlib
from collections import Counter

import pytest

from punctual.llm import spelling
from punctual.llm.common import table

LOWER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def brute_words(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def grouped(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    return sorted(map(tuple, spelling.variant_groups(df, **options).collect()))


def dense(rng, n, alphabet="abñ", sizes=(7, 8, 9, 12)):
    """Words over few letters, with many near ones and runs of a letter."""
    words = {}
    while len(words) < n:
        word = "".join(rng.choices(alphabet, k=rng.choice(sizes)))
        words[word] = rng.choice([1, 2, 3, 30, 400, 5000])
    return words


@pytest.mark.parametrize("frequent", [1, 8, 1024])
@pytest.mark.parametrize("hot", [3, 40, 10_000])
def test_equals_brute_force(spark, frequent, hot):
    words = dense(random.Random(frequent * hot), 500)
    assert grouped(spark, words, frequent=frequent, hot=hot) == brute(words)


@pytest.mark.parametrize("shortest", [4, 6, 9])
def test_other_shortest_words(spark, shortest):
    words = dense(random.Random(shortest), 300, "abc", (shortest, shortest + 1, shortest + 5))
    assert grouped(spark, words, shortest=shortest, frequent=16) == brute(words)


def test_words_of_four_characters_need_grams_of_two(spark):
    words = dense(random.Random(1), 60, "abc", (4, 5))
    assert grouped(spark, words, shortest=4) == brute(words)
    with pytest.raises(ValueError, match="4 characters"):
        grouped(spark, words, shortest=3)
    with pytest.raises(ValueError, match="fewer than 5"):
        grouped(spark, words, shortest=5)


def test_chains_ties_and_loops(spark):
    words = {
        "abcdefg": 2, "abcdefgh": 20, "abcdefghi": 300, "xbcdefghi": 300, "abcdefghij": 5000,
        "abcdefghijk": 60_000, "zzzzzzz": 5, "zzzzzzy": 50, "zzzzzzx": 50, "qqqqqqq": 9, "qqqqqqqq": 89,
    }
    got = {r[0]: r for r in grouped(spark, words)}
    assert got["abcdefg"] == ("abcdefg", "abcdefgh", "abcdefghijk", 2, 1, 20)
    assert got["zzzzzzz"][1] == "zzzzzzx" and got["zzzzzzz"][4] == 2  # the smaller of two
    assert got["qqqqqqq"][1] is None  # not quite ten times
    assert sorted(got.values()) == brute(words)


def test_long_words(spark):
    rng = random.Random(6)
    for size, hot in ((300, 2), (50_000, spelling.HOT_LIST)):
        base = "".join(rng.choices("abcdefgh", k=size))
        middle = base[: size // 2] + "x" + base[size // 2 + 1 :]
        words = {base: 500, base[:-1]: 3, base[1:]: 4, middle: 5, base + "y": 6, "short" * 2: 2}
        words |= {base[: 9 + i]: 2 for i in range(25)}
        words |= {"a" * size: 2, "a" * (size + 1): 30}
        assert grouped(spark, words, hot=hot) == brute(words)


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [("abcdefg", 1), ("abcdefg", 2), (None, 5), ("abcdefx", None), ("abcdefy", 30)]
    df = spark.createDataFrame(rows, "word string, n bigint").withColumnRenamed("n", "n")
    got = sorted(map(tuple, spelling.variant_groups(df).collect()))
    assert got == brute({"abcdefg": 3, "abcdefy": 30})
    assert spelling.variant_groups(df.where("false")).isEmpty()
    assert spelling.op13_spelling(spark.createDataFrame([], "doc_id bigint, text string")).isEmpty()


def test_words_of_odd_texts(spark):
    docs = [
        (1, "Straße straße STRASSE Straße élèves ÉLÈVES Élèves élèves"), (2, None), (3, ""), (None, "Aaaaaaa aaaaaaa"),
        (4, "abcdefg1abcdefg,abcdefgĀabcdefg×abcdefg"), (4, "abcdefg1abcdefg,abcdefgĀabcdefg×abcdefg"),
        (5, "longword " * 20_000), (6, "x" * 200_000), (7, "x" * 200_000),
    ]
    docs += [(i, "wonderful beginnings everywhere") for i in range(10, 200)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.word: r.n for r in spelling.words(df).collect()}
    assert got == brute_words(docs)
    assert len(got) > 8  # some occurrences have lost a character


def test_the_query_equals_brute_force_on_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    near = {}
    for word in words:  # words with the same rest are near, or one is the other's rest
        for i in range(len(word)):
            near.setdefault((i, word[:i] + word[i + 1 :]), []).append(word)
    counts = Counter()
    for (_, rest), some in near.items():
        for word in some:
            counts[word] += len(some) - 1
    for word in words:
        rests = {word[:i] + word[i + 1 :] for i in range(len(word))} & set(words)
        counts[word] += len(rests)
        for rest in rests:
            counts[rest] += 1
    got = spelling.op13_spelling(docs).collect()
    assert {r.word: r.n for r in got} == words
    assert {r.word: r.n_near for r in got if r.n_near} == {w: n for w, n in counts.items() if n}


def test_every_word_of_one_edit_has_a_list_in_common():
    rng = random.Random(9)
    for _ in range(20_000):
        word = "".join(rng.choices("abc", k=rng.randrange(7, 40)))
        at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        other = word[:at] + (rng.choice("abc") if kind else "") + word[at + (kind != 2) :]
        if len(other) < 7 or other == word:
            continue
        grams = frozenset(a + b for a in "abc" for b in "abc" if rng.random() < 0.5)

        def contexts(w, grams=grams):
            return {w[: m // 2] if m % 2 else (w[len(w) - m // 2 :],) for m in spelling.marks(w, grams, 3)}

        assert contexts(word) & contexts(other), (word, other, grams)


def test_frequent_grams_are_extended():
    dictionary = frozenset(["th", "he"])
    assert spelling.grams("thexy", dictionary, 3) == [(0, 3), (1, 4), (3, 5)]
    assert spelling.grams("xthe", dictionary, 3) == [(0, 2), (1, 4)]
    assert spelling.grams("xy", dictionary, 3) == [(0, 2)]
    assert spelling.grams("x", dictionary, 3) == []
