import random
import time
import unicodedata
from itertools import combinations

import numpy as np
from edge import SCHEMA, clashing, with_edges

from msgflow.llm import decontamination
from msgflow.llm.decontamination import (
    MATCH,
    _filters,
    _pieces,
    align,
    intact_seeds,
    item_seeds,
    item_words,
    leaks,
    most_score,
    passages,
    plain_words,
    seeds_asked,
    seeds_left_out,
)
from msgflow.llm.queries import op5_decontamination
from msgflow.llm.text import BLOCK_BYTES, WORDS, runs


def plain_align(p, q):
    """Local alignment with match 2, mismatch and gap -1, cell by cell."""
    table = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(1, len(p) + 1):
        for j in range(1, len(q) + 1):
            step = 2 if p[i - 1] == q[j - 1] else -1
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def test_alignment():
    rng = random.Random(3)
    pairs = [([rng.randint(0, 4) for _ in range(rng.randint(0, 30))], [rng.randint(0, 4) for _ in range(rng.randint(1, 20))]) for _ in range(200)]
    found = align([np.array(p, np.int64) for p, _ in pairs], [np.array(q, np.int64) for _, q in pairs])
    assert found.tolist() == [plain_align(p, q) for p, q in pairs]


def test_bound_of_the_alignment():
    rng = random.Random(4)
    pairs = [([rng.randint(0, 30) for _ in range(rng.randint(1, 40))], [rng.randint(0, 30) for _ in range(rng.randint(1, 20))]) for _ in range(300)]
    bound = most_score([np.array(p, np.int64) for p, _ in pairs], [np.array(q, np.int64) for _, q in pairs])
    scores = np.array([plain_align(p, q) for p, q in pairs])
    assert (bound >= scores).all() and (bound < [2 * len(q) for _, q in pairs]).any()


def words(rng, n):
    return [f"w{rng.randint(0, 3000)}" for _ in range(n)]


def test_whole_edited_and_common_passages(spark):
    rng = random.Random(5)
    items = [(k, words(rng, 40)) for k in range(8)]
    edited = list(items[1][1])
    for at in (7, 15, 23, 31):
        edited[at] = "changed"
    edited.insert(20, "added")
    docs = {
        1: words(rng, 100) + items[0][1] + words(rng, 100),
        2: words(rng, 5) + edited + words(rng, 5),
        3: words(rng, 300),
        4: items[2][1][:30],
        5: items[3][1][:12] + words(rng, 40),
        6: words(rng, 200_000) + items[4][1] + words(rng, 200_000) + items[5][1],
        7: [w.upper() + "," for w in items[6][1]],
    }
    docs |= {100 + k: words(rng, 20) + items[7][1] + words(rng, 20) for k in range(60)}
    rows = [(d, " ".join(w), "en", "s", 1) for d, w in docs.items()]
    frame = clashing(spark.createDataFrame(rows, SCHEMA), "words", "seed", "item_id", "id")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(90, None), (91, ""), (92, "two words")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.share for r in leaks(frame, bench).collect()}
    assert set(found) == {(1, 0), (2, 1), (4, 2), (6, 4), (6, 5), (7, 6), *((100 + k, 7) for k in range(60))}
    assert found[1, 0] == found[6, 4] == found[7, 6] == 1
    assert 0.6 < found[2, 1] < 1 and abs(found[4, 2] - 0.75) < 0.1


def test_edited_short_copies_of_an_item_that_is_everywhere(spark):
    """Copies with one or two seeds left, all of them held by hundreds of passages."""
    rng = random.Random(6)
    item = [f"q{k}" for k in range(14)]
    changes = {"whole": (), "one": (3, 8, 12), "two": (3, 9, 12)}
    docs = {}
    for k in range(300):
        for n, at in enumerate(changes.values()):
            docs[3 * k + n] = words(rng, 10) + [f"e{k}" if i in at else w for i, w in enumerate(item)] + words(rng, 10)
    docs[5000] = words(rng, 10) + item[4:8] + words(rng, 10)
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = {r.doc_id: (r.score, r.shared_seeds) for r in leaks(frame, bench).collect()}
    assert set(found) == set(range(900))
    assert all(found[d][0] == plain_align(docs[d], item) for d in (0, 1, 2))
    assert [found[d][1] for d in (0, 1, 2)] == [12, 4, 4]  # seeds of three words


def test_item_longer_than_a_block(spark):
    rng = random.Random(7)
    item = [f"{k:03d}" + "z" * 1200 for k in range(240)]
    short = words(rng, 20)
    docs = {1: words(rng, 50) + item + words(rng, 50), 2: item[:150], 3: item[:60], 4: words(rng, 30) + short}
    assert len(" ".join(item)) > BLOCK_BYTES
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in leaks(frame, bench).collect()}
    assert found == {(1, 1): 480, (2, 1): 300, (4, 2): 40}


def test_pieces_carry_the_shared_words():
    """Wherever a document is cut, each of its stretches of ``shared`` words lies whole in some piece, at its place."""
    rng = random.Random(8)
    long = [f"{k}" + "y" * rng.randint(0, 3000) for k in range(900)]
    for split, shared in ((" ", 0), (" ", 40), (" ", 400), (" ", 5000), (",", 40)):
        text = np.frombuffer(split.join(long).encode(), np.uint8)
        whole = runs(text, np.array([0, len(text)]), WORDS).hashes
        covered, reached = np.zeros(len(long), bool), 0
        for position, hashes in _pieces(text, 0, len(text), shared):
            assert (hashes == whole[position : position + len(hashes)]).all()
            assert reached == 0 or position <= max(0, reached - shared)
            covered[position : position + len(hashes)] = True
            reached = position + len(hashes)
        assert covered.all() and reached == len(long)


def test_copies_across_the_borders_of_pieces(spark):
    """With words so long that a block holds fewer than the shared ones, edited copies lie on every border."""
    rng = random.Random(9)
    item = words(rng, 40)
    copy = [w if k % 6 else "changed" for k, w in enumerate(item)]
    unlike = [f"{k:04d}" + "y" * 700 for k in range(900)]
    head = " ".join(unlike[:360])
    docs = {k: [head, "x" * (BLOCK_BYTES - len(head) - 2 - k), *copy, *unlike[360:]] for k in range(0, len(" ".join(copy)), 20)}
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    score = plain_align(copy, item)
    assert {r.doc_id: r.score for r in leaks(frame, bench).collect()} == dict.fromkeys(docs, score)


def test_item_ids_that_repeat_or_are_null(spark):
    rng = random.Random(10)
    texts = [words(rng, 20) for _ in range(4)]
    docs = {k: words(rng, 30) + w + words(rng, 30) for k, w in enumerate(texts)}
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    items = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[3])]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id bigint, text string")
    found = sorted(((r.doc_id, r.item_id, r.score) for r in leaks(frame, bench).collect()), key=repr)
    assert found == sorted([(0, 1, 40), (1, 1, 40), (2, None, 40), (3, None, 40), (3, 2, 40)], key=repr)


def test_short_items_edges_and_empty_tables(spark, sf_dir):
    docs = with_edges(spark, sf_dir)
    bench = spark.createDataFrame([(1, "an id that is null"), (2, "one"), (3, "A NEGATIVE id")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert {(None, 1), (9_000_005, 2), (-7, 3)} <= found
    empty = spark.createDataFrame([], SCHEMA)
    assert leaks(empty, bench).collect() == []
    assert leaks(docs, bench.limit(0)).collect() == []


def edited(rng, item, share):
    """The words of an item, each replaced, left out or followed by another word with a probability, replaced most often."""
    out = []
    for word in item:
        chance = rng.random()
        if chance < share * 0.7:
            out.append(f"new{rng.randint(0, 10**6)}")
        elif chance < share * 0.85:
            continue
        else:
            out += [word] + ([f"added{rng.randint(0, 10**6)}"] if chance < share else [])
    return out


def test_recall_of_edited_copies(spark):
    """Copies of items of 8, 14 and 20 words with 10, 20 and 30 % edits: of those that reach the share 95 % are found at least, at their score."""
    rng = random.Random(11)
    items = {k: words(rng, (8, 14, 20)[k % 3]) for k in range(90)}
    docs, made = {}, {}
    for k in range(2700):
        share, item = (0.1, 0.2, 0.3)[k % 3], k // 3 % 90
        copy = edited(rng, items[item], share)
        docs[k] = words(rng, 15) + copy + words(rng, 15)
        made[k] = item, share, plain_align(docs[k], items[item])
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in leaks(frame, bench).collect()}
    recall = {}
    for d, (item, share, score) in made.items():
        if score >= len(items[item]):
            assert found.get((d, item), score) == score
            recall.setdefault((len(items[item]), share), []).append((d, item) in found)
    recall = {k: sum(v) / len(v) for k, v in recall.items()}
    print(recall)
    assert len(recall) == 9 and min(recall.values()) >= 0.95


def test_a_benchmark_too_large_to_know(spark, monkeypatch):
    """Without the tasks' knowledge of seeds the same pairs are found."""
    rng = random.Random(15)
    items = {k: words(rng, 8 + k) for k in range(40)}
    docs = {k: words(rng, 200) + edited(rng, items[k % 40], 0.2) + words(rng, 200) for k in range(200)}
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    known = {(r.doc_id, r.item_id, r.score) for r in leaks(frame, bench).collect()}
    monkeypatch.setattr(decontamination, "MOST_KNOWN_SEEDS", 0)
    assert {(r.doc_id, r.item_id, r.score) for r in leaks(frame, bench).collect()} == known and len(known) > 150


def test_every_fourth_word_replaced(spark):
    rng = random.Random(12)
    item = words(rng, 24)
    copy = [f"x{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    frame = spark.createDataFrame([(1, " ".join(words(rng, 9) + copy), "en", "s", 1)], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    assert [r.score for r in leaks(frame, bench).collect()] == [plain_align(copy, item)]


def test_words_of_other_scripts_and_signs(spark):
    chinese = "长江是亚洲最长的河流也是世界第三长的河流"
    russian = "Волга впадает в Каспийское море через широкую дельту у города Астрахань"
    english = "The teacher's \"old\" rule - never run indoors - wasn't followed by anyone at the school"
    french = "Où était l'élève quand l'école a brûlé près de la forêt l'été dernier"
    items = {1: chinese, 2: russian, 3: english, 4: french}
    docs = {
        1: f"前文{chinese}后文还有很多字",
        2: f"ВОТ ТЕКСТ: {russian.upper()}!",
        3: "So: " + english.replace("'", "\u2019").replace(' "', " \u201c").replace('" ', "\u201d ").replace(" - ", " \u2014 "),
        4: "«" + unicodedata.normalize("NFD", french) + "»",
        5: "nothing of this kind — \u201cat all\u201d",
    }
    frame = spark.createDataFrame([(d, t, "xx", "s", 1) for d, t in docs.items()], SCHEMA)
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.share for r in leaks(frame, bench).collect()}
    assert found == {(k, k): 1.0 for k in items}


def test_a_phrase_that_thousands_of_items_share(spark):
    """Documents and items that have only a common phrase in common are not paired; what holds more of an item is."""
    rng = random.Random(13)
    phrase = "which of the following statements is true about".split()

    def seconds(n):
        items = [(k, " ".join(phrase + [f"i{k}x{j}" for j in range(12)])) for k in range(n)]
        docs = {k: words(rng, 10) + phrase + words(rng, 10) for k in range(n)}
        docs[n] = words(rng, 10) + items[7][1].split()[:-4] + words(rng, 10)
        frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
        began = time.time()
        found = leaks(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()
        assert [(r.doc_id, r.item_id) for r in found] == [(n, 7)]
        return time.time() - began

    seconds(1500)
    small, large = seconds(1500), seconds(6000)
    assert large < 4 * small + 2


def test_seeds_left_out_leave_enough():
    """With a third of its words replaced, wherever they are, a short item keeps the seeds that are asked for."""
    for n in range(2, 13):
        for gone in combinations(range(n), n // 3):
            intact = sum(k not in gone and k + 1 not in gone for k in range(n - 1))
            assert intact >= intact_seeds(n)
        assert n < 3 or intact_seeds(n) - seeds_left_out(n) >= min(seeds_asked(n), intact_seeds(n))


def test_long_and_short_items_together(spark):
    """One very long item does not widen the passages of the short ones, and both are found."""
    rng = random.Random(14)
    long, short = words(rng, 3000), words(rng, 14)
    docs = {1: words(rng, 500) + long[:2000] + words(rng, 500), 2: words(rng, 20_000) + short + words(rng, 20_000), 3: words(rng, 50)}
    frame = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in docs.items()], SCHEMA)
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in leaks(frame, bench).collect()}
    assert found[2, 2] == 28 and found[1, 1] >= 4000 and len(found) == 2
    seeds = item_seeds(item_words(bench, "item_id", "text"))
    rows = passages(frame, "doc_id", "text", _filters(seeds)).where("class = 4").selectExpr("max(size(words)) as n").first()
    assert rows.n <= 7 * 16


def test_query_equals_aligning_everything(spark, sf_dir):
    """Every document with every item, cell by cell."""
    rows = {(r.doc_id, r.item_id): (r.score, r.share) for r in op5_decontamination(spark, sf_dir).collect()}
    docs = {r.doc_id: plain_words(r.text or "").split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: plain_words(r.text).split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    number: dict[str, int] = {}
    coded = lambda w: np.array([number.setdefault(x, len(number) + 1) for x in w], np.int64)
    docs, items = {d: coded(w) for d, w in docs.items()}, {i: coded(w) for i, w in items.items()}
    expected = {}
    for d, p in docs.items():
        scores = align([p] * len(items), list(items.values()))
        expected |= {(d, i): (s, s / (MATCH * len(q))) for (i, q), s in zip(items.items(), scores.tolist()) if s >= len(q)}
    assert expected and rows == expected


def test_query_finds_what_contains_an_item(spark):
    """Against a plain look-up of whole items in the words of whole documents, and the score of each alignment found."""
    import re

    sf_dir = "/root/testdata/sf0.01"
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    docs = {r.doc_id: split(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: split(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r for r in op5_decontamination(spark, sf_dir).collect()}
    joined = {d: f" {' '.join(w)} " for d, w in docs.items()}
    whole = {(d, i) for i, w in items.items() for d, t in joined.items() if f" {' '.join(w)} " in t}
    assert whole and whole <= set(found)
    for (d, i), r in found.items():
        if len(docs[d]) < 3000:
            assert r.score == plain_align(docs[d], items[i])
            assert r.share == r.score / (MATCH * len(items[i]))
