import random
import re
import textwrap

from helpers import AWKWARD, awkward, empty, got

from cartlens.llm import licenses


def bigrams(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return {tuple(w[k : k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else {(x,) for x in w}


def passages(text):
    out = re.split("\r?\n", text) + re.split(r"(?<=[.!?])\s+", text) + re.split(r"\n\s*\n", text) + [text]
    return list(dict.fromkeys(out))


def brute(rows, templates, least=0.8):
    out = []
    for d, t in rows:
        best = {}
        for p in passages(t or ""):
            a = bigrams(p)
            for name, template in templates.items():
                b = bigrams(template)
                dice = round(2 * len(a & b) / (len(a) + len(b)), 6) if a and b else 0
                if dice >= least:
                    best[name] = max(best.get(name, 0), dice)
        name = min(best, key=lambda n: (-best[n], n)) if best else None
        out.append((d, name, best.get(name, 0.0), len(best), sorted(best)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "license", "dice", "n_licenses", "licenses")
MIT = licenses.TEMPLATES["MIT (text)"]
TEXTS = [
    "some prose.\nLicensed under CC BY-NC 4.0.\nmore prose",
    "prose before. Released under the MIT license. prose after, on one line",
    "one\n\n" + MIT.replace(". ", ".\n").replace("copy, modify", "copy; modify,") + "\n\nlast",
    MIT.replace("free of charge", "without charge"),
    "This work is licensed under the GNU General Public License, version 3.\nLicensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-SA 3.0.\r\nlicensed UNDER cc by-sa 3.0",
    "the license of the work is not given here at all",
    "Copyright all rights reserved",
]


def test_equals_brute_force(spark):
    rows = [(d, t) for d, t, _ in AWKWARD] + [(50 + k, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], "doc_id bigint, text string, license string, size int")
    assert got(licenses.scan(df), *COLUMNS) == brute(rows, licenses.templates())


def test_own_templates_and_similarity(spark):
    own = {"a": "one two three four five six", "b": "one two three four five seven", "c": "single"}
    rows = [(1, "one two three four five six"), (2, "one two three four five eight"), (3, "Single!"), (4, "one two"), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (0.5, 0.8, 1.0):
        assert got(licenses.scan(df, own, similarity=least), *COLUMNS) == brute(rows, own, least)


def test_empty_and_native(spark):
    assert licenses.scan(empty(spark)).count() == 0
    plan = licenses.matches(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PROSE = "Some prose about other things stands here. It goes on for a while, and says nothing of rights."
# published layouts: paragraphs parted by blank lines, lines of about 70 characters
PARTS = {
    "MIT (text)": ("subject to the following conditions:", "substantial portions of the Software."),
    "ISC (text)": ("notice appear in all copies.",),
    "BSD-2-Clause (conditions)": ("conditions are met:", "following disclaimer."),
    "Apache-2.0 (notice)": ("compliance with the License.", "LICENSE-2.0"),
    "BSD-3-Clause (text)": ("conditions are met:", "following disclaimer.", "with the distribution.", "prior written permission."),
    "ISC (full text)": ("notice appear in all copies.",),
    "GPL-3.0-or-later (whole notice)": ("any later version.",),
}


def published(name):
    text = licenses.TEMPLATES[name]
    for end in PARTS[name]:
        text = text.replace(end + " ", end + "\n\n", 1)
    return "\n\n".join(textwrap.fill(p, 70) for p in text.split("\n\n"))


def test_published_layout_in_a_longer_document(spark):
    rows = [(k, f"{PROSE}\n\n{published(name)}\n\n{PROSE}") for k, name in enumerate(PARTS)]
    # one paragraph that other prose goes on, a line that is broken, a piece that is neither line nor sentence
    rows.append((10, f"{PROSE} {licenses.TEMPLATES['Apache-2.0 (notice)']} {PROSE}"))
    rows.append((11, "A title\nLicensed under\nthe MIT License.\n" + PROSE))
    rows.append((12, f"prose with no end\nReleased under the MIT License. {PROSE}"))
    rows.append((13, f"{PROSE}\n\n" * 50 + published("MIT (text)") + f"\n\n{PROSE}" * 50))
    rows.append((14, f"{PROSE} {PROSE}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = licenses.scan(df).collect()
    found = {r["doc_id"]: (r["license"], r["dice"]) for r in out}
    listed = {r["doc_id"]: r["licenses"] for r in out}
    for k, name in enumerate(PARTS):  # a text may hold another one wholly, as BSD-3-Clause the conditions of BSD-2-Clause
        assert name in listed[k] and found[k][1] > 0.97, name
    assert found[10][0] == "Apache-2.0 (notice)" and found[10][1] > 0.97
    assert found[11] == ("MIT (licensed under)", 1.0) and found[12] == ("MIT", 1.0) and found[13][0] == "MIT (text)"
    assert found[14] == (None, 0.0)


def test_runs_equal_brute_force(spark):
    own = {"a": "one two three four five six seven eight", "b": "five six seven eight nine ten", "c": "one two"}
    draw = random.Random(3)
    word = "one two three four five six seven eight nine ten x y".split()
    rows = [(k, "".join(draw.choice(word) + draw.choice((" ", " ", ". ", "\n")) for _ in range(30))) for k in range(60)]
    rows += [(100 + k, "one two three.\nfour five six\nseven eight " * (k + 1)) for k in range(3)]
    want = []
    for d, t in rows:
        pieces = [p for p in re.split(r"(?<=[.!?])\s+|\r?\n", t) if bigrams(p)]
        runs = [" ".join(pieces[a:z]) for a in range(len(pieces)) for z in range(a + 1, len(pieces) + 1)]
        best = {}
        for p in [*runs, *passages(t)]:
            for name, template in own.items():
                a, b = bigrams(p), bigrams(template)
                dice = round(2 * len(a & b) / (len(a) + len(b)), 6) if a else 0
                if dice >= 0.6:
                    best[name] = max(best.get(name, 0), dice)
        name = min(best, key=lambda n: (-best[n], n)) if best else None
        want.append((d, name, best.get(name, 0.0), len(best), sorted(best)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(licenses.scan(df, own, similarity=0.6), *COLUMNS) == sorted(want, key=repr)


def test_many_copies_in_one_document(spark):
    # lines with a number of their own between the copies; a copy that differs a little; one with a long repeat inside
    altered = published("MIT (text)").replace("sublicense", "sublicence and resell")
    many = "\n\n".join(f"Component number {k}\n{altered}" for k in range(1500))
    half = published("MIT (text)").split("\n\n")
    held = f"{PROSE}\n" + half[0] + "\n" + "a line again\n" * 50_000 + "\n".join(half[1:])
    rows = [(1, altered), (2, many), (3, held)]
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(many) > 1_500_000 and out[2]["license"] == "MIT (text)"
    assert out[2]["dice"] == out[1]["dice"] < 1
    t = len(bigrams(MIT))  # "a line again" adds four bigrams and parts one
    assert out[3]["dice"] == round(2 * (t - 1) / (t + t - 1 + 5), 6)
