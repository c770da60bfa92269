import hashlib
import random

import regex
from pyspark.sql import functions as F

from millrace.llm.licenses import (
    COPYRIGHT_LINE,
    HOLDER_LINE,
    KNOWN,
    PHRASES,
    SPELLINGS,
    TEXTS,
    WIDER,
    digest,
    known_licenses,
    known_texts,
    license_report,
    scan,
    scan_lines,
)

MIT = KNOWN[0][1]


def test_spellings_of_one_text(spark):
    texts = [
        MIT,
        MIT.upper().replace(",", "").replace("\n", " "),
        "Copyright (c) 2024 Somebody\n\n" + MIT,
        "MIT License\n\n  * Copyright 1999-2003 A, B. All rights reserved.\n" + MIT,
        MIT.replace("COPYRIGHT HOLDERS", "copyright-holders").replace("sublicense", "sub-license"),
        MIT.replace("NONINFRINGEMENT", "non-infringement"),
        MIT + " More.",
        MIT[:-10],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.license_ids for r in license_report(df, known_licenses(spark)).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 5: "MIT", 6: "", 7: ""}


def test_whole_texts_of_common_licenses(spark):
    texts = {p.stem.removesuffix(".regents"): p.read_text() for p in sorted(TEXTS.glob("*.txt"))}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
            "CC0-1.0", "Unlicense"} <= set(texts)
    rows = [(i, t) for i, t in texts.items()] + [(i, " ".join(t.upper().split())) for i, t in texts.items() if "Copyright" not in t]
    rows += [("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright Jane Doe\n\n" + texts["BSD-2-Clause"])]
    rows += [("Apache-2.0", texts["Apache-2.0"].partition("END OF TERMS")[0].replace("http:", "https:"))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = license_report(df, known_licenses(spark)).collect()
    assert len(got) == len(rows) and [r for r in got if r.license_ids != r.doc_id] == []


def test_holders_without_a_year(spark):
    lines = ["Copyright Jane Doe", "© Jane Doe", "(c) Jane Doe", "Copyright [yyyy] [name]", "# Copyright: The X Authors, x.org.",
             "Copyright (C) by Jane Doe <jane@x.org>\r", "Copyright <YEAR> <COPYRIGHT HOLDER>", "©山田太郎"]
    text = ["COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "copyright notice and this permission notice shall be", "(c) You must retain it",
            "Copyright Law", "Copyrights OF Others"]
    rows = [(x, f"{x}\n\n{MIT}") for x in lines + text] + [("long", "Copyright " + "A " * 50_000 + "\n" + MIT)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id for r in license_report(df, known_licenses(spark)).where("license_ids = 'MIT'").collect()}
    assert got == {*lines, "long"}


def test_wider_spellings(spark):
    a = "We organise, optimise: favourite fulfilment of labelling"
    b = "we organize, optimize favorite fulfillment of labeling"
    df = spark.createDataFrame([(1, a), (2, b), (3, b + " x")], "doc_id long, text string")
    known = spark.createDataFrame([("L", a)], "license_id string, text string")
    assert {r.doc_id for r in license_report(df, known).where("license_ids = 'L'").collect()} == {1, 2}


def test_equivalent_words(spark):
    df = spark.createDataFrame([("The licence, whilst fulfil!", "the LICENSE while fulfill"), ("a b", "a c")], "a string, b string")
    assert [r.same for r in df.select((digest(F.col("a")) == digest(F.col("b"))).alias("same")).collect()] == [True, False]


def test_lines_and_edges(spark, edges, empty):
    known = spark.createDataFrame([("L", "a, B  c"), ("M", "A b-c"), ("N", None), ("O", "!")], "license_id string, text string")
    got = license_report(edges, known)
    assert got.count() == edges.count()
    assert {(r.doc_id, r.license_ids, r.notice_ids) for r in got.where("license_ids <> ''").collect()} == {(None, "L,M", "L,M")}
    lines = spark.createDataFrame([(1, "x\n A B C.\ny")], "doc_id long, text string")
    assert scan(lines, known).count() == 0 and scan_lines(lines, known).count() == 2
    assert license_report(empty, known).count() == 0


def plain_form(text, wide):
    """The canonical or the wider form, step by step as the docstring tells them."""
    if wide:
        text = regex.sub(HOLDER_LINE.replace("(?md)", "(?m)"), " ", text)
    text = "".join(c.lower() if c.isascii() else c for c in text)
    text = regex.sub(COPYRIGHT_LINE.replace("(?md)", "(?m)"), " ", text)
    text = " ".join(regex.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", text).split(" "))
    text = " " + regex.sub(" +", " ", text).strip(" ") + " "
    for phrase, other in PHRASES.items():
        text = text.replace(f" {phrase} ", f" {other} " if other else " ")
    found = [SPELLINGS.get(w, w) for w in text.split(" ")]
    return " ".join(WIDER.get(w, w) if wide else w for w in found).strip(" ")


def test_report_equals_plain_forms(spark, con):
    """Mixed texts of known and unknown lines, holders, spellings, blank lines and odd breaks."""
    rng = random.Random(3)
    notices = [t for i, t in KNOWN if "\n" not in t]
    pool = [*notices, *[t.upper() for t in notices], "Copyright 2001 A", "© Jane Doe", "Copyright (c) Some One, and others",
            "", " ", "-- ", "All rights reserved.", "whilst honouring the labelling", "licence", "per\tcent", "non-commercial use",
            "Released  under the MIT-licence!", "\r", "x\ry", "été ß 日本", "sub", "license", "copyright owner", *MIT.split("\n")]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 8))) for _ in range(400)]
    texts += [r[0] for r in con.execute("SELECT text FROM documents WHERE text IS NOT NULL").fetchall()] + known_sample()
    known = known_texts() + [("SUB", "sub\nlicence"), ("PC", "Percent"), ("HON", "while honoring the labeling\n© Nobody At All")]
    digests = {}
    for i, t in known:
        if form := plain_form(t, True):
            digests.setdefault(form, set()).add(i)
    listed = lambda parts: ",".join(sorted(set().union(*[digests.get(plain_form(p, True), set()) for p in parts])))
    expected = []
    for n, t in enumerate(texts):
        form = plain_form(t, False)
        digest = hashlib.sha256(form.encode()).hexdigest() if form else None
        expected.append((n, digest, listed([t]), listed(t.split("\n"))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    licenses = spark.createDataFrame(known, "license_id string, text string")
    assert sorted(tuple(r) for r in license_report(df, licenses).collect()) == expected
    assert sum(bool(r[2]) for r in expected) > 20 and sum(bool(r[3]) for r in expected) > 100
    k1 = {r.k1: r.doc_id for r in df.selectExpr("doc_id", "xxhash64(doc_id) AS k1").collect()}
    for found, at in ((scan(df, licenses), 2), (scan_lines(df, licenses), 3)):
        ids = {}
        for r in found.collect():
            ids.setdefault(k1[r.k1], set()).add(r.license_id)
        assert {n: ",".join(sorted(i)) for n, i in ids.items()} == {r[0]: r[at] for r in expected if r[at]}


def known_sample():
    return [f"Copyright 2020 Z\n{t}" for _, t in known_texts()[:40]]
