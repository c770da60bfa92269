"""License scans: texts are brought to a canonical form, and whole texts are looked up by its digest.

The canonical form has A-Z in lower case, no copyright lines, no "all rights reserved", words of
letters and digits with one space between them, and one spelling of words that are spelled in several
ways. Its SHA-256 is joined to the digests of known texts, so that a text is never compared with a
text. `scan` looks up whole texts, and `scan_lines` each line as a text of its own, as short notices
stand on a line among others. DataFrame functions only.

The digest that a report names is that of the canonical form. Texts are looked up by a wider form, which
on top of that has no holder's lines without a year, and more words in one spelling. A holder's line
starts with "Copyright", "(c)" or "©", and names somebody, in any number of words: with capitals, in
brackets, addresses, or words as "of" and "and". Lines of running text stay.

A text is folded, freed of copyright lines and squeezed once, with its line breaks kept; the whole form and those
of its lines are both taken from that. Of the lines, only those whose form has the length of some known
form are hashed, as no other can have its digest.

The known texts are a frame (license_id, text), which the join broadcasts if its real size is small:
`KNOWN` and the whole texts in the folder `license_texts`, with and without titles and appendices.

A NULL or blank text, or one that is blank in its canonical form, has no digest and matches nothing.
Several known texts with one digest are all reported, in the order of their ids. Repeated rows are answered
alike. Texts of any length are looked up whole. Other columns are left out of the report. Empty tables give no
rows, and without known texts nothing is found.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.rows import fold, fresh, row_key
from millrace.session import stage

# Words of one meaning, and the spelling that stands for them.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "cancelled": "canceled", "catalogue": "catalog",
    "centre": "center", "favour": "favor", "fulfil": "fulfill", "initialise": "initialize",
    "judgement": "judgment", "labour": "labor", "licence": "license", "licences": "licenses",
    "licenced": "licensed", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "organisation": "organization", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
PHRASES = {
    "all rights reserved": "", "copyright owner": "copyright holder", "sub license": "sublicense",
    "non commercial": "noncommercial", "non infringement": "noninfringement", "per cent": "percent",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

# Known texts, (license_id, text). Titles and copyright lines may precede a text.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

COPYRIGHT_LINE = r"(?md)^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*((19|20)[0-9][0-9]|\(c\)|©)[^\n]*$"

# Further spellings, of which the lookup knows on top.
_IZE = """apolog author capital categor central character critic custom emphas final formal general harmon
    initial legal local material maxim minim modern neutral normal optim organ parallel penal real recogn
    serial special standard summar synchron util visual""".split()
_OR = "behavio colo disfavo endeavo favo flavo harbo hono labo neighbo".split()
_ONE_L = "cance channe counse labe mode signa trave".split()
WIDER = {
    **{f"{a}is{b}": f"{a}iz{b}" for a in _IZE for b in ("e", "ed", "es", "er", "ers", "ing", "ation", "ations")},
    **{f"{a}ur{b}": f"{a}r{b}" for a in _OR for b in ("", "s", "ed", "ing", "able", "ably", "ite", "ites")},
    **{f"{a}ll{b}": f"{a}l{b}" for a in _ONE_L for b in ("ed", "ing", "er", "ers")},
    "acknowledgements": "acknowledgments", "analogues": "analogs", "analysed": "analyzed", "analysing": "analyzing",
    "artefacts": "artifacts", "calibre": "caliber", "catalogues": "catalogs", "catalogued": "cataloged",
    "centres": "centers", "defence": "defense", "defences": "defenses", "fulfilment": "fulfillment",
    "fulfils": "fulfills", "https": "http", "judgements": "judgments", "licencing": "licensing",
    "licencee": "licensee", "licencees": "licensees", "licencor": "licensor", "offences": "offenses",
    "practised": "practiced", "practising": "practicing", "programmes": "programs", "sublicence": "sublicense",
    "sublicences": "sublicenses", "sublicenced": "sublicensed", "wilfully": "willfully",
}
HOLDER_LINE = (
    r"(?md)^[ \t#*/;-]*(?:(?i:copyright)(?=[ \t:,(©])|\([cC]\)|©)[ \t:,]*(?:\([cC]\)|©)?[ \t:,]*"
    r"(?!(?i:owners?|holders?|notices?|laws?|licen[sc]e|and|or|in|to|interests?|statements?|acts?|treaty|treaties"
    r"|infringement|protection|rights?|permission)\b)"
    r"(?:(?:\[[^\]\n]*\]|<[^>\n]*>|\{[^}\n]*\}|[^\s\p{Ll}]\S*|[^\s@:/.]*[@:/.]\w\S*"
    r"|(?:all|and|authors?|by|contributors?|d[aeiou]|der|developers|et|its|la|members|of|others|project|reserved"
    r"|rights|team|the|v[ao]n)(?![\w]))[.,;]*(?:[ \t]+|(?=\r?$)))++\r?$"
)
TEXTS = Path(__file__).resolve().parent / "license_texts"
TITLES = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
LAST_LINE = "END OF TERMS AND CONDITIONS"  # of the terms; an appendix may follow


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, in which `value` is worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _squeezed(text: Column) -> Column:
    """The text folded, without copyright lines, words with a space on both sides, and ` \\n ` between lines."""
    plain = F.regexp_replace(fold(text), COPYRIGHT_LINE, " ")
    plain = F.regexp_replace(plain, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), " *\n *", " \n ")


def _one_line(squeezed: Column) -> Column:
    return F.regexp_replace(squeezed, " *\n[ \n]*", " ")


def _rephrased(plain: Column) -> Column:
    """Phrases and words in one spelling; both stay within a line."""
    for phrase, other in PHRASES.items():
        plain = F.replace(plain, F.lit(f" {phrase} "), F.lit(f" {other} " if other else " "))
    return plain


def canonical(text: Column) -> Column:
    """The canonical form; NULL for a NULL text."""
    return _once(_rephrased(_one_line(_squeezed(text))), lambda one: F.trim(_respelled(one)))


def _respelled(plain: Column, spelled: dict[str, str] = SPELLINGS) -> Column:
    spellings = F.create_map(*[F.lit(x) for pair in spelled.items() for x in pair])
    respelled = F.array_join(
        F.transform(F.split(plain, " "), lambda w: F.coalesce(F.try_element_at(spellings, w), w)), " "
    )
    # One look for any of the spellings spares most texts the rest.
    any_spelling = f" {_any_of(list(spelled))} "
    return F.when(plain.rlike(any_spelling), respelled).otherwise(plain)


def _any_of(words: list[str]) -> str:
    """A pattern of any of the words, by their first letters, so that few are tried at a place."""
    tails: dict[str, list[str]] = {}
    for word in words:
        tails.setdefault(word[:1], []).append(word[1:])
    ends = tails.pop("", None) is not None
    whole = "|".join(head + _any_of(rest) for head, rest in tails.items())
    return f"(?:{whole}){'?' if ends else ''}" if whole else ""


def _hashed(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form in lower-case hex; NULL where that is NULL or blank."""
    return _once(canonical(text), _hashed)


def _held(text: Column) -> Column:
    """The text without holders' lines."""
    return F.when(text.rlike(HOLDER_LINE), F.regexp_replace(text, HOLDER_LINE, " ")).otherwise(text)


def _wider(form: Column) -> Column:
    """The wider form of a canonical form whose words have a space on both sides."""
    return _once(form, lambda one: _respelled(one, WIDER))


def forms(docs: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """`docs` with two columns, whose names are returned: the text without holders' lines, and that squeezed.

    Generated columns, so that each is worked out once, whatever is then made of it.
    """
    held, squeezed = fresh(docs, "_held", "_squeezed")
    docs = docs.withColumn(held, F.explode(F.array(_held(F.col(text)))))
    return docs.withColumn(squeezed, F.explode(F.array(_squeezed(F.col(held))))), held, squeezed


def _whole(squeezed: Column) -> Column:
    """The canonical form of a squeezed text, with a space on both sides."""
    return _once(_rephrased(_one_line(squeezed)), lambda one: _respelled(one))


def _wide_form(text: Column) -> Column:
    return F.trim(_wider(_whole(_squeezed(_held(text)))))


def known_digests(licenses: DataFrame) -> DataFrame:
    """(wide, length, license_id), distinct, of known texts (license_id, text): digest and length of the wider form."""
    found = licenses.select(_wide_form(F.col("text")).alias("form"), "license_id")
    found = found.select(_hashed(F.col("form")).alias("wide"), F.char_length("form").alias("length"), "license_id")
    return stage(found.where("wide IS NOT NULL").distinct())


def known_texts() -> list[tuple[str, str]]:
    """(license_id, text): `KNOWN` and the shipped texts, whole, without appendix, and under titles."""
    # A file is named by its licence, and by its wording where there are several.
    plain = [(path.stem.removesuffix(".regents"), path.read_text("utf-8")) for path in sorted(TEXTS.glob("*.txt"))]
    plain += [(i, t[: t.index(LAST_LINE)] + end) for i, t in plain if LAST_LINE in t for end in ("", LAST_LINE)]
    plain += [("MIT", _MIT), ("ISC", _ISC)]
    return KNOWN + plain + [(i, f"{title}\n\n{t}") for i, t in plain for title in TITLES.get(i, [])]


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def scan(docs: DataFrame, licenses: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(k1, k2, license_id): rows of `docs` whose entire text is a known text."""
    keyed = _keyed(docs, text, doc_id)
    form = F.explode(F.array(_wide_form(F.col("text")))).alias("form")
    return _looked_up(keyed.select("k1", "k2", form), known_digests(licenses))


def scan_lines(docs: DataFrame, licenses: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(k1, k2, license_id): rows of `docs` with a line that is a known text."""
    formed, _, squeezed = forms(_keyed(docs, text, doc_id), "text")
    return _looked_up(formed.select("k1", "k2", F.explode(_line_forms(F.col(squeezed))).alias("form")), known_digests(licenses))


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    keys = [c.alias(n) for c, n in zip(row_key(doc_id, text), ("k1", "k2"))]
    return docs.select(*keys, F.col(text).alias("text"))


def _line_forms(squeezed: Column) -> Column:
    """The wider forms of a squeezed text's lines, with spaces at their ends."""
    spelled = _wider(_once(_rephrased(squeezed), lambda one: _respelled(one)))
    return F.split(spelled, "\n", -1)


def _looked_up(formed: DataFrame, known: DataFrame) -> DataFrame:
    """(…, license_id): rows whose `form` is a known one; only forms of a known length are hashed."""
    formed = formed.withColumn("form", F.trim("form")).where("form <> ''")
    lengths = known.select("length").distinct()
    same = formed.withColumn("length", F.char_length("form")).join(lengths, "length", "left_semi")
    hashed = same.withColumn("wide", F.sha2("form", 256)).drop("form", "length")
    return hashed.join(known.drop("length"), "wide").drop("wide").distinct()


def license_report(
    docs: DataFrame, licenses: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, digest, license_ids, notice_ids): sorted ids of the entire text and of its lines.

    Ids are joined by commas; the text is empty where there are none. One pass over the texts writes,
    for each, the digests and the lines whose length some known text has.
    """
    known = known_digests(licenses)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    formed, held, squeezed = forms(rows, "text")
    whole = formed.withColumn("_whole", F.explode(F.array(_whole(F.col(squeezed)))))
    # The lengths are as many as known texts at most; they go into the plan as one list.
    lengths = F.array(*[F.lit(r.length) for r in known.select("length").distinct().collect()]).cast("array<int>")
    lines = F.transform(_line_forms(F.col(squeezed)), lambda one: F.trim(one))
    lines = F.filter(lines, lambda one: F.array_contains(lengths, F.char_length(one)))
    narrow = F.when(F.col(held) == F.col("text"), F.trim("_whole")).otherwise(canonical(F.col("text")))
    keys = [c.alias(n) for c, n in zip(row_key("doc_id", "text"), ("_k1", "_k2"))]
    report = stage(
        whole.select(
            "doc_id",
            *keys,
            _once(narrow, _hashed).alias("digest"),
            _once(F.trim(_wider(F.col("_whole"))), _hashed).alias("wide"),
            F.array_distinct(F.transform(lines, lambda one: F.sha2(one, 256))).alias("line_digests"),
        )
    )
    keys, columns = ["_k1", "_k2"], []
    known = known.drop("length")
    for name, found in (
        ("license_ids", report.select(*keys, "wide")),
        ("notice_ids", report.select(*keys, F.explode("line_digests").alias("wide"))),
    ):
        ids = found.join(known, "wide").groupBy(*keys)
        ids = ids.agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias(name))
        report = report.join(stage(ids), keys, "left")
        columns.append(F.coalesce(name, F.lit("")).alias(name))
    return report.select("doc_id", "digest", *columns)
