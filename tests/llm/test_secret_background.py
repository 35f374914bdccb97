"""op9's background is counted over all documents: against plain counts."""

import random
from collections import Counter

from sluice.llm import secret_scan as S


def _texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefmnorstuv") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts = [f"{rng.choice(words)} {rng.choice(words).title()} {rng.randint(1, 99)} a-b.{rng.choice(words)} AKIA{rng.randint(0, 9)}" for _ in range(4100)]
    texts += [f"password={rng.choice(words)}{i} é" + "".join(rng.choice("0123456789abcdef") for _ in range(30)) for i in range(60)]
    return texts + ["", None, "x" * 3000, "=" * 50]


def test_background_counts_every_document(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = Counter()
    for t in texts:
        taken = [(s, e) for s, _, e, _ in S.base_spans(t or "")]
        for m in S.RUN.finditer(t or ""):
            if all(m.end() <= s or e <= m.start() for s, e in taken):
                inner = [x for x in S.SYMBOL.split(m[0]) if x]
                parts.update(inner if inner == [m[0]] else [m[0], *inner])
    want = Counter()
    for v, n in parts.items():
        if n > 1 or S.ORDINARY.fullmatch(v):
            want[S.classes(v), bool(S.ORDINARY.fullmatch(v))] += n
    got, rows = Counter(), S.ordinary(docs).collect()
    for r in rows:
        got[r.symbols, r.word] += r.n
    assert got == want
    # the model is that of a list of the same parts, and the held-out words are the rest
    model, words = S.background(S.ordinary(docs))
    assert model.counts == S.Background.of(S.class_triples((r.symbols, r.n) for r in rows if not r.held)).counts
    assert Counter({r.symbols: r.n for r in words.collect()}) == Counter({r.symbols: r.n for r in rows if r.held and r.word})
    automaton = S.fit([f"{i:06d}" for i in range(100)], model)
    held = [(r.symbols, r.n) for r in words.collect()]
    over, of = S.alarms(words, [automaton, None], model)
    assert over == [sum(n for x, n in held if S.ratio(automaton, model, x) >= automaton.limit), 0] and of == sum(n for _, n in held)


def test_few_parts_are_learned_from_and_held_out(spark):
    docs = spark.createDataFrame([(1, "one two one"), (2, "three 4")], "doc_id long, text string")
    model, words = S.background(S.ordinary(docs))
    assert model.counts == S.Background([("one", 2), ("two", 1), ("three", 1), ("4", 1)]).counts
    assert sum(r.n for r in words.collect()) == 5


def test_runs_of_the_same_classes_are_scored_once(spark):
    rng = random.Random(6)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    models = [S.learn([pick("0123456789abcdef", 32) for _ in range(80)], [("word", 50), ("Other", 9), ("12", 4)]),
              S.learn(["AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16) for _ in range(80)], [("word", 50), ("Other", 9), ("12", 4)])]
    texts = [" ".join(pick(rng.choice(["0123456789abcdef", "9fzZ", "AKI2-", "ghi"]), rng.choice([5, 32, 32, 20])) for _ in range(30)) for _ in range(20)]
    texts += ["9f" * 16 + " AKIA" + "Z9" * 8 + " 1231" + "Z9" * 8 + " x-AKIA" + pick("ABCXYZ0123", 16)]
    known = {}
    got = [S.grammar_spans(t, [], models, known) for t in texts * 2]
    assert got == [S.grammar_spans(t, [], models) for t in texts * 2] and any(got)
