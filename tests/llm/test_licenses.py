import random

import pytest

from userflow.llm import licenses
from userflow.llm.licenses import Template

HEADER = licenses.TEMPLATES[2].text
BY_LABEL = {}
for t in licenses.TEMPLATES:
    BY_LABEL.setdefault(t.label, []).append(t.text)


def brute(text, templates=licenses.TEMPLATES, phrases=licenses.PHRASES):
    """All windows of all templates, one by one: the row's values, and the blocks that stay."""
    own = licenses.cut(text or "")
    known = licenses.known(templates)
    stride = licenses.stride_of(known)
    spots, base = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
        spots += at
        base |= {label} if at else set()
    best = {}
    for k in known:
        for i in range(len(own)):
            window = set(own[i : i + k.span])
            shared = len(window & set(k.words))
            if own[i] in k.words and set(k.telling) <= window and shared >= k.least:
                key = (k.number, i // stride)
                if key not in best or shared > best[key][2]:
                    best[key] = (k, i, shared)

    def beaten(m):
        k, i, n = m
        for o, j, s in best.values():
            if o.label != k.label and j < i + k.span and i < j + o.span:
                ahead = s * len(k.words) - n * len(o.words)
                if ahead > 0 or (ahead == 0 and len(o.words) > len(k.words)):
                    return True
        return False

    kept = [m for m in best.values() if not beaten(m)]
    labels = base | {k.label for k, _, _ in kept}
    score = 1.0 if spots else max([n / len(k.words) for k, _, n in kept], default=0.0)
    first, last = (min(spots), max(spots)) if spots else (None, None)
    row = len(own), len(spots), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score
    return row, [(k.number, k.label, i, k.span, n, len(k.words)) for k, i, n in kept]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    prose = " ".join(draw.choice(["the", "license", "mit", "wort", "ünter", "a"]) for _ in range(9000))
    rows = [
        (1, None), (2, ""), (3, "..."), (4, "Released UNDER the MIT license."), (5, "under the\nmit--license"),
        (6, "cc by nc cc by nc cc by nc"), (7, "under the mit licenses"), (8, "xunder the mit license"),
        (9, HEADER), (10, HEADER.replace("hereby", "").replace("charge", "cost")), (11, prose + " " + HEADER + " " + prose),
        (12, "the license mit"), (13, "Apache License, Version 2.0 and CC BY-NC 4.0"), (13, "other"), (13, "other"), (None, HEADER), (None, None),
        (14, "under\u00a0the mit license"), (15, "under the \u212a mit license mit"), (16, prose), (17, "Under the MIT License " * 3),
        (18, prose + " " + BY_LABEL["bsd-3"][0] + prose + BY_LABEL["apache-2"][1]), (19, HEADER), (19, HEADER),
    ]
    words = [w for t in licenses.TEMPLATES for w in licenses.cut(t.text)]
    for i in range(60):
        text = licenses.cut(draw.choice(licenses.TEMPLATES).text)
        for _ in range(draw.randrange(6)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((100 + i, " ".join(draw.choices(words, k=draw.randrange(90)) + text + draw.choices(words, k=draw.randrange(90)))))
    return rows


def test_whole_texts(documents, rows):
    got = sorted(str(tuple(r)) for r in licenses.scan(documents(rows)).collect())
    assert got == sorted(str((i, *brute(t)[0])) for i, t in rows)
    assert brute(rows[8][1])[0][5] == "mit" and brute(rows[4][1])[0][3] == 0


def test_blocks_and_their_places(documents, rows):
    got = sorted(str((r.doc_id, *tuple(r)[2:])) for r in licenses.matches(documents(rows)).collect())
    assert got == sorted(str((i, *m)) for i, t in set(rows) for m in brute(t)[1])
    assert len(got) > 40


LABELS = {
    "Released under the Apache license.": "",
    "Licensed under CC BY SA 4.0": "cc-by-sa",
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License version 2": "gpl-2",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl-3",
    "General Public License": "",
    "the committee released its report under the new license rules": "",
    "Das Haus mit dem Garten und mit der Tür. Licensed under the Apache License, Version 2.0.": "apache-2",
    "Licensed under the Apache License, Version 1.1": "",
    "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
}


def test_rivals_are_told_apart(documents):
    texts = {**LABELS, **{text: label for label, own in BY_LABEL.items() for text in own}}
    rows = list(enumerate(texts))
    got = {r.doc_id: r.labels for r in licenses.scan(documents(rows), phrases={}).collect()}
    assert {text: got[i] for i, text in rows} == texts


def test_prose_with_a_license_word_is_not_labelled(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id in (725, 7800, 8118)")
    assert {r.doc_id: r.labels for r in licenses.scan(docs).collect()} == {725: "apache-2", 7800: "apache-2", 8118: "apache-2"}


def test_given_templates_and_phrases_are_cut_in_words(documents):
    own = [Template("own", "c++", "My (C++) Terms.*"), Template("wide", "", "Alpha, BETA; gamma")]
    rows = [(1, "these are my c terms"), (2, "alpha beta gamma"), (3, "my terms"), (4, "In A.B!")]
    got = {r.doc_id: (r.base_labels, r.labels) for r in licenses.scan(documents(rows), {"A.b": "ab"}, own).collect()}
    assert got == {1: ("", "own"), 2: ("", "wide"), 3: ("", ""), 4: ("ab", "ab")}
    assert [r.labels for r in licenses.scan(documents(rows), {"a b": "ab"}, []).orderBy("doc_id").collect()] == ["", "", "", "ab"]
    assert licenses.matches(documents(rows), []).collect() == []
    for wrong in ([Template("x", "", "...")], [Template("x", "other", "words")]):
        with pytest.raises(ValueError):
            licenses.scan(documents(rows), templates=wrong)
    with pytest.raises(ValueError):
        licenses.scan(documents(rows), {"!": "x"})


def test_no_documents(documents):
    assert licenses.scan(documents([])).collect() == []
    assert licenses.matches(documents([])).collect() == []
