import random
import re
import time

from pyspark.sql import functions as F

from tests.llm.frames import SCHEMA, awkward, awkward_rows, prose, rows_of, with_clashes
from tradeloom.llm import licenses

TEXTS = {
    1: "This is Licensed under the MIT License, and more under the MIT license.",
    2: "Apache License, Version 2.0 (the License)", 3: "see CC-BY-NC 4.0; cc by\nnc sa",
    4: "SPDX-License-Identifier: GPL-2.0-or-later", 5: "GNU General Public License, version 3",
    6: "under the mité license", 7: "Unter der MIT Lizenz, avec cc byé nc", 8: "All rights reserved.",
    9: "Licensed under the Apache License, Version 2.0 and the Mozilla Public License 2.0",
    10: "the cc by nc " * 400,
}
MORE = {
    1: "mit", 2: "apache-2", 3: "cc-by-nc,cc-by-nc-sa", 4: "gpl-2-or-later", 5: "gpl-3", 6: "", 7: "",
    8: "proprietary", 9: "apache-2,mpl-2", 10: "cc-by-nc",
}


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, found = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                found.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(found)))


def test_base_equals_brute_force(spark):
    rows = awkward_rows() + [(1000 + k, t, "en", "s", 1) for k, t in TEXTS.items()]
    rows += [(2000 + k, f"{prose(k, 3000)} {t} {prose(k, 50)}", "en", "s", 1) for k, t in TEXTS.items()]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA), "labels", "n_words", "score", "at")
    found = rows_of(licenses.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert found == sorted([(r[0], *plain(r[1])) for r in rows], key=key)


def test_labels_and_scores(spark):
    rows = [(k, t, "en", "s", 1) for k, t in TEXTS.items()]
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r.labels for k, r in out.items()} == MORE
    assert out[1].score == 1.0 and out[6].score == 0.0 and 0 < out[8].score < 1 and out[4].score == 1.0


def test_detections_inside_stronger_ones_go(spark):
    rows = [(k, t, "en", "s", 1) for k, t in TEXTS.items()]
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        places = [(d.first, d.stop, d.strength) for d in r.detections]
        for i, (a, b, s) in enumerate(places):
            assert 0 <= a < b
            for j, (c, d, t) in enumerate(places):
                assert i == j or not (c <= a and b <= d and t <= s)


def test_rules_are_many_ordered_and_gated():
    rules = licenses.rules()
    assert len(rules) > 200 and all(re.compile(r[4]) for r in rules)


def test_keyword_gate(spark):
    rows = [("A LICENSE", True), ("x CC y", True), ("cc0", True), ("success accent", False), ("", False),
            ("write without prejudice", False), ("All Rights\nReserved", True), ("ccé cc1", False)]
    frame = spark.createDataFrame(rows, "t string, wanted boolean")
    found = frame.select("wanted", licenses._speaks(F.lower("t")).alias("got")).collect()
    assert all(r.wanted == r.got for r in found), found


def gated_and_not(spark, texts):
    """Detections by the query, and by every rule on every text."""
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], SCHEMA)
    one = {r.doc_id: r.detections for r in licenses.scan(docs).collect()}
    words = licenses.normalised(F.col("text"))
    other = docs.select("doc_id", licenses.detections(words, by_keyword=False).alias("d")).collect()
    return [one[k] for k in range(len(texts))], [r.d for r in sorted(other)]


def test_keywords_count_without_a_word_for_license(spark):
    texts = ["released under the 3-clause BSD", "Distributed under BSD-2-Clause.", "available under the Mozilla Public",
             "published under the Artistic", "the GNU General Public, version x", "see the Mozilla Public",
             "used under zlib/libpng", "covered under OpenSSL", "a general in public", "no such thing"]
    gated, every = gated_and_not(spark, texts)
    assert gated == every
    assert [d[0].label if d else None for d in gated] == [
        "bsd-3-clause", "bsd-2-clause", "mpl", "artistic", "gpl", "mpl", "zlib", "openssl", None, None]


def spelled(pick, parsed):
    """A random string that a parsed regex matches."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            out += chr(pick.choice([x for kind, x in arg if str(kind) == "LITERAL"] or [arg[0][1][0]]))
        elif op == "BRANCH":
            out += spelled(pick, pick.choice(arg[1]))
        elif op == "SUBPATTERN":
            out += spelled(pick, arg[-1])
        else:
            assert op == "MAX_REPEAT"
            out += "".join(spelled(pick, arg[2]) for _ in range(pick.randint(arg[0], arg[1])))
    return out


def test_every_spelling_of_a_rule_has_its_keyword(spark):
    pick = random.Random(1)
    texts = []
    for _, keyword, _, _, regex in licenses.rules():
        for _ in range(40):
            texts.append(spelled(pick, re._parser.parse(regex)))
            assert re.fullmatch(regex, texts[-1]) and keyword in texts[-1], (regex, texts[-1])
    frame = spark.createDataFrame([(t,) for t in sorted(set(texts))], "t string")
    assert frame.where(~licenses._speaks(F.col("t"))).collect() == []


def test_keyword_gate_loses_nothing(spark):
    texts = ["licensed under the GNU GPL version 3", "GNU GPL v2", "Creative Commons Zero license", "released under MIT",
             "the Do What The Fuck You Want To Public License", "GNU Library General Public License v2",
             "GNU Library General Public License", *TEXTS.values()]
    gated, every = gated_and_not(spark, texts)
    assert gated == every
    assert [d[0].label for d in gated[:7]] == ["gpl-3", "gpl-2", "cc0", "mit", "wtfpl", "lgpl-2", "lgpl"]


def settled(found):
    """The rule for overlaps, straight from its words: (first, stop, strength, ...) that stay."""
    order = sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3], d[4]))
    return [d for i, d in enumerate(order) if not any(
        e[1] >= d[1] and e[2] <= d[2] for e in order[:i])]


def test_detections_equal_brute_force(spark):
    pick = random.Random(5)
    parts = ["licensed under the", "mit license", "cc by nc sa 4 0", "apache license version 2 0", "and", "gnu",
             "general public license", "all rights reserved", "bsd 3 clause", "or later", "version 3", "the", "text"]
    texts = [" ".join(pick.choice(parts) for _ in range(n)) for n in (0, 1, 2, 5, 12, 30, 80, 300)]
    gated, every = gated_and_not(spark, texts)
    assert gated == every
    for text, got in zip(texts, gated):
        words, found = f" {text} ", []
        for label, _, strength, confidence, rule in licenses.rules():
            for m in re.finditer(f"(?<= )(?:{rule})(?= )", words):
                first = words[:m.start()].count(" ") - 1
                found.append((first, first + m.group().count(" ") + 1, strength, label, confidence))
        assert [(d.first, d.stop, d.strength, d.label, d.confidence) for d in got] == settled(found)


def test_many_matches_in_one_text(spark):
    """Time is about linear in the matches: 200,000 of them in one text."""
    n = 200_000
    docs = spark.createDataFrame([(1, "see cc by nc now " * n, "en", "s", 1)], SCHEMA)
    start = time.monotonic()
    row = licenses.scan(docs).select(
        "n_words", "n_base", "first_word", "last_word", "labels", F.size("detections").alias("n")).first()
    assert tuple(row) == (5 * n, n, 1, 5 * n - 4, "cc-by-nc", n)
    assert time.monotonic() - start < 60


def test_empty(spark):
    assert licenses.labels(spark.createDataFrame([], SCHEMA)).collect() == []
