"""Cut texts are told from complete ones on held-out planted cuts."""

import random

from folioforge.llm.truncation import report, segments, tail, truncated

NOUNS = "harbour lantern orchard steeple sorrow village thunder servant river garden window miller prayer cellar".split()
VERBS = "warned measured blessed remembered carried opened followed answered".split()
ADVERBS = "gently slowly inwardly often rarely".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, kind string, row string"


def sentence(rng):
    n, v, a = (lambda: rng.choice(NOUNS)), (lambda: rng.choice(VERBS)), (lambda: rng.choice(ADVERBS))
    forms = [
        lambda: f"The {n()} {a()} {v()} the {n()}, because the {n()} and its {n()} {v()} the {n()}",
        lambda: f"No {n()} ever {v()} a {n()} so {a()} as the {n()} that {v()} the {n()}",
        lambda: f"If a {n()} {v()} the {n()}, the {n()} will not ask why the {n()} {v()} it",
    ]
    return rng.choice(forms)()


def corpus():
    rng = random.Random(12)
    rows, cut = [], set()
    for k in range(3000):
        text = ". ".join(sentence(rng) for _ in range(rng.randrange(3, 9))) + "."
        source = rng.choice(["limited", "free", "poems"])
        if source == "limited" and len(text) > 300:
            text = text[:300]
            if not text.endswith((".", ". ")):
                cut.add(k)
        elif source == "free" and rng.random() < 0.08:
            last = text.rstrip(".").rfind(". ")
            text = text[: rng.randrange(last + 12, len(text) - 8)] + rng.choice(["", "", "…", "�", " <p"])
            cut.add(k)
        elif source == "poems":
            text = text[:-1] + rng.choice(["", "…", "...", "\n\nFINIS", ".\n\nAnn Lurie"])
        rows.append((k, text, rng.choice(["en", "EN", None]), source, "x", "y"))
    rows += [(5000, None, "en", "free", "", ""), (5001, "", None, "free", "", ""), (5002, " \n", "en", None, "", ""), (5003, "Done.", "en", None, "", ""), (5004, "a. " * 100_000 + "Done.", "en", "free", "", "")]
    return rows, cut


def test_planted_cuts(spark):
    rows, cut = corpus()
    judged = truncated(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = judged.collect()
    assert len(got) == len(rows)
    found = {r.doc_id for r in got if r.is_cut}
    hit = len(found & cut)
    assert hit >= 0.95 * len(cut) and hit >= 0.95 * len(found)
    assert not found & {5000, 5001, 5002, 5003, 5004}
    by = {r.source: r for r in report(judged).collect()}
    assert by["poems"].cut_share < 0.02 and by[None].n_docs == 2 and sum(r.n_docs for r in by.values()) == len(rows)


def test_copies_are_one_witness(spark):
    rows, _ = corpus()
    cut = "The harbour gently warned the miller, because the window and its river opened the prayer. No river ever warned a miller so"
    whole = "No harbour ever warned a miller so gently as the window that opened the prayer\n\nFINIS"
    rows += [(6000 + k, cut, "en", f"s{k // 2}", "", "") for k in range(40)] + [(8000 + k, whole, "en", "poems", "", "") for k in range(40)]
    found = {r.doc_id for r in truncated(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect() if r.is_cut}
    assert set(range(6000, 6040)) <= found and not found & set(range(8000, 8040))


def test_tails():
    assert tail(None)[0] == tail(" \n")[0] == "empty"
    assert tail("It is done.")[0] == tail('He said "so".')[0] == tail("It is. 🙏")[0] == tail("Done?\n\n")[0] == "closed"
    assert tail("It is thoug�") == ("broken", "It is thoug") and tail("It is <p")[0] == "broken"
    assert tail("It is not…")[0] == tail("It is not...")[0] == "ellipsis" and tail("It is (see ch.")[0] in ("closed", "bare")
    assert [(s.strip(), m) for s, m in segments("One (Gapan, ch. 14) here. Two\n\nThree")] == [("One (Gapan, ch. 14) here", True), ("Two", False), ("Three", False)]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert truncated(df).count() == 0 and report(truncated(df)).count() == 0
