"""Planted page noise is found, named and taken out again."""

import random
import re

from folioforge.llm.page_noise import BODY, BREAK, FEATURES, HEADER, HEADER_PAGE, HEADING, PAGE, Labels, Names, Words, lines_of, repaired

WORDS = "the granary warned sudden gatekeeper inwardly measured congregation while harbour blessed orchard morning steeple lantern sorrow journey whisper remember twice-told grave-faced servant village thunder".split()
SCHEMA = "node_id bigint, source_file string, text string, id string, title string"
#: What the tests plant: the usual misreadings of printed letters, of their own and not those of the operator.
MISREAD = [("o", "0"), ("l", "1"), ("i", "l"), ("e", "c"), ("rn", "m"), ("m", "rn"), ("h", "li"), ("d", "cl"), ("n", "ri"), ("s", "5"), ("g", "9")]
CATALOG = [("a.pdf", "The Quiet Harbour, or the Papers", "The Quiet Harbour", "Ann Lurie", 1), ("b.PDF", "Other Things", None, None, 1), (None, "x", "y", "z", 1)]


def prose(rng, n=60):
    out = []
    for _ in range(n // 12):
        s = [rng.choice(WORDS) for _ in range(12)]
        out.append(" ".join([s[0].capitalize(), *s[1:]]) + ".")
    return " ".join(out)


def wrap(text, width=50):
    lines, now = [], ""
    for w in text.split(" "):
        if now and len(now) + len(w) + 1 > width:
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    return [*lines, now]


def plant(rng, text, kind):
    lines = wrap(text)
    k = rng.randrange(1, len(lines) - 1)
    if kind == "hyphenation":
        word = next((w for w in lines[k].split(" ")[1:-1] if len(w) >= 6 and w.isalpha()), None)
        if word is None:
            return plant(rng, text, kind)
        a, b = lines[k].split(f" {word} ", 1)
        cut = rng.randrange(2, len(word) - 2)
        lines[k : k + 1] = [f"{a} {word[:cut]}{rng.choice('-‐=¬')}", f"{word[cut:]} {b}"]
    elif kind == "misread":
        printed, read = rng.choice([c for c in MISREAD if c[0] in lines[k].split(" ", 1)[1]])
        head, rest = lines[k].split(" ", 1)
        lines[k] = head + " " + rest.replace(printed, read, 1)
    elif kind == "running_header":
        lines.insert(k, rng.choice(["THE QUIET HARBOUR", "Ann Lurie", "The Quiet Harbour, or the Papers", "Thc Quiet Harb0ur."]))
    else:
        lines.insert(k, rng.choice(["217", "- 12 -", "Page 4", "xiv", "[88]"]))
    return "\n".join(lines)


def test_planted(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(400):
        kind = rng.choice([None, "hyphenation", "misread", "running_header", "page_number"])
        text = prose(rng)
        rows.append((k, "a.pdf", plant(rng, text, kind) if kind else "\n".join(wrap(text)), "", ""))
        want[k] = (kind, text)
    rows += [(1000 + k, "c.epub", prose(rng), "", "") for k in range(400)] + [(2000, "c.epub", "The Quiet Harbour\n12", "", "")]
    rows += [(3000, "a.pdf", None, "", ""), (3001, "a.pdf", "", "", ""), (3002, None, "12\n", "", ""), (3003, "b.PDF", "  \n ", "", ""), (3004, "zz.pdf", "The Quiet Harbour\n" + prose(rng), "", "")]
    df = spark.createDataFrame(rows + rows[:30], SCHEMA).repartition(4)
    catalog = spark.createDataFrame(CATALOG, "source_file string, title string, short_title string, author string, id int")
    got = {r.node_id: r for r in repaired(df, catalog).collect()}
    assert set(got) == {*range(400), 3001, 3003, 3004}
    right = [k for k, (kind, _) in want.items() if got[k].noise == ([kind] if kind else [])]
    clean = [k for k, (_, text) in want.items() if got[k].clean_text == text]
    assert len(right) >= 0.97 * len(want) and len(clean) >= 0.95 * len(want)
    assert got[3001].clean_text == got[3003].clean_text == "" and got[3001].noise == []
    found = repaired(df, catalog, with_text=False)
    assert found.columns == ["node_id", "noise"] and repaired(df.limit(0), catalog).count() == 0


def states(text, names):
    return Labels()(lines_of(text, names)[1])


def test_labels():
    names = Names("The Quiet Harbour", None, "Ann Lurie")
    long = "The sudden lantern inwardly measured the steeple while the village"
    for line, state in [
        ("", BREAK), ("ANN LURIE", HEADER), ("12   The Quiet Harbour", HEADER_PAGE), ("The Quiet Harbour      xi", HEADER_PAGE), ("Thc Quict Harb0ur", HEADER),
        ("p. 9", PAGE), ("- 241 -", PAGE), ("[88]", PAGE), ("CHAPTER XIV", HEADING), ("Prayers   52", HEADING), ("HYMN 4", HEADING), ("warned.", BODY), ("1700.", PAGE),
    ]:
        assert states(f"{long}.\n{line}\n{long}\nended here.", names)[1] == state, line
    assert states("The Quiet Harbour", names) == [HEADER] and states("217", names) == [PAGE] and states(long, names) == [BODY]
    assert len({len(v) for v in FEATURES.values()}) == 1


def test_the_lines_around_decide():
    names = Names("The Quiet Harbour")
    long = "The sudden lantern inwardly measured the steeple while the village"
    inside, apart = states(f"{long}\nOld Ann Lurie\n{long}.", names), states(f"{long}.\n\nOld Ann Lurie\n\n{long}.", names)
    assert inside[1] == BODY and apart[2] == HEADING


def test_words():
    words = Words(frozenset(("pre", "and", "told", "twice", "sorrow", "morning", "the")), frozenset(("twice-told",)))
    assert words.rejoined("sor", "row", True) == "sorrow" and words.rejoined("sor", "row", False) == "sorrow"
    assert words.rejoined("twice", "told", True) == "twice-told" and words.rejoined("pre", "and", True) is None
    assert words.corrected("m0rning") == "morning" and words.corrected("rnoming") == "morning" and words.corrected("xyz") is None and words.corrected("the") is None
    assert re.match("a", "a")
