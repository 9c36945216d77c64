import random

from examsift.llm import leakage as lk

WORDS = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("arn", "est", "ilk", "ond", "ump", "ath", "enny", "iss")]
RNG = random.Random(4)
BODY = " ".join(RNG.choices(WORDS, k=25)) + " [blank_1] " + " ".join(RNG.choices(WORDS, k=30)) + "."
OTHER = " ".join(RNG.choices(WORDS, k=60))


def noise(n, seed):
    return " ".join(random.Random(seed).choices([w + "x" for w in WORDS], k=n))


def run(spark, texts, passages=(("s1", BODY), ("s2", OTHER)), **more):
    records = spark.createDataFrame([("c", i, t) for i, t in enumerate(texts)], "corpus string, row_key bigint, texts array<string>")
    named = spark.createDataFrame(list(passages), "seed_id string, body string")
    return sorted((r.row_key, r.seed_id) for r in lk.find_leaks(records, named, **more).collect())


def test_whole_and_partial_leaks_in_long_texts(spark):
    w = BODY.replace("[blank_1] ", "").rstrip(".").split()
    filled = BODY.replace("[blank_1]", "answer word")
    edits = w[:26]
    edits[4], edits[14] = "changed", "altered"
    dropped = w[:12] + w[13:22] + ["added"] + w[22:26]
    texts = [
        [noise(3000, 1) + " " + BODY + " " + noise(2000, 2)],
        ["<p>" + filled.upper().replace(" ", "\n> ") + "</p>"],
        [noise(50, 3) + " " + " ".join(w[30:51]) + " " + noise(50, 4)],  # 21 words
        [noise(50, 5) + " " + " ".join(edits) + " " + noise(50, 6)],
        [noise(50, 7) + " " + " ".join(dropped) + " " + noise(50, 8)],
        [noise(50, 9) + " " + " ".join(w[30:44]) + " " + noise(50, 10)],  # 14 words: a shorter quotation
        [" ".join(x if i % 3 else "zz" for i, x in enumerate(w))],  # a third changed
        [" ".join(w[:10]), " ".join(w[10:20])],  # no single text has enough
        [noise(400, 11)],
        [None, "", BODY + " " + OTHER],
        None,
        [],
    ]
    assert run(spark, texts) == [(0, "s1"), (1, "s1"), (2, "s1"), (3, "s1"), (4, "s1"), (9, "s1"), (9, "s2")]


def test_blocks_of_passages_give_the_same(spark):
    texts = [[BODY], [OTHER], [noise(100, 1) + BODY + OTHER]]
    assert run(spark, texts, at_once=1) == run(spark, texts) == [(0, "s1"), (1, "s2"), (2, "s1"), (2, "s2")]


def test_empty_sides(spark):
    records = spark.createDataFrame([], "corpus string, row_key bigint, texts array<string>")
    named = spark.createDataFrame([], "seed_id string, body string")
    assert lk.find_leaks(records, named).collect() == []
    assert run(spark, [[BODY]], passages=(("s0", ""), ("s3", "too short"))) == []


def test_held_out_passages(spark):
    q = "Body text. Choices: A. x B. y"
    rows = [("a", q, "evaluation"), ("a", q, "evaluation"), ("b", q, "generation"), (None, q, "evaluation"), ("c", None, "evaluation"), ("d", "No list", "evaluation")]
    seeds = spark.createDataFrame(rows, "seed_id string, source_question string, use_for string")
    assert sorted(map(tuple, lk.held_out_passages(seeds).collect())) == [("a", "Body text."), ("d", "No list")]


def test_search_equals_alignment_of_everything():
    rng = random.Random(9)
    passages = [(f"p{i}", " ".join(rng.choices(WORDS, k=70))) for i in range(12)]
    index = lk.PassageIndex(passages)
    texts = []
    for i in range(300):
        part = passages[rng.randrange(12)][1].split()
        at, n = rng.randrange(40), rng.randint(8, 30)
        quote = part[at : at + n]
        for _ in range(rng.randint(0, 3)):
            quote[rng.randrange(len(quote))] = "other"
        texts.append(noise(rng.randint(0, 300), i) + " " + " ".join(quote) + " " + noise(rng.randint(0, 300), i + 1000))
    found = index.search(texts)
    for text, hits in zip(texts, found):
        words = lk.WORD.findall(lk.clean(text))
        every = {o for o in range(12) if any(index.aligned(o, words[a : a + 90])[0] >= 20 for a in range(0, len(words), 30))}
        assert {o for o, _, _ in hits} == every
    assert sum(map(bool, found)) > 50


def test_two_and_three_blanks_with_edits():
    rng = random.Random(11)
    bodies = []
    for k in range(12):
        w = rng.choices(WORDS, k=44)
        for place in (14, 21, 27)[: 2 + k % 2]:
            w[place] += " [blank_1]"
        bodies.append((f"b{k}", " ".join(w)))
    index = lk.PassageIndex(bodies)
    texts, owners = [], []
    for i in range(600):
        k, size = rng.randrange(12), rng.choice([20, 20, 21, 22, 24, 30])
        words, _ = lk.passage_words(bodies[k][1])
        at = rng.randint(max(0, 28 - size), 13)
        quote = words[at : at + size]
        for place in rng.sample(range(1, size - 1), size // 8):
            quote[place] = "other"
        for place in (27, 21, 14)[1 - k % 2 :]:
            if place - at + 1 < size:
                quote[place - at + 1 : place - at + 1] = ["fill"] * rng.randint(1, lk.FILL)
        owners.append(k)
        texts.append(noise(rng.randint(30, 300), i) + " " + " ".join(quote) + " " + noise(rng.randint(30, 300), i + 1000))
    missed = [i for i, (k, hits) in enumerate(zip(owners, index.search(texts))) if k not in {o for o, _, _ in hits}]
    assert missed == []


def test_agreements_needed_grow_with_overlap():
    assert lk.agreements_needed(36, 18, 10, 64) < lk.agreements_needed(18, 18, 10, 64) < 64
