from __future__ import annotations

import random

import pytest
from llm_fixtures import SF, docs, edge_docs, no_docs  # noqa: F401

from corpusloom.llm import license_scan
from corpusloom.llm.queries import QUERIES

SPLIT = {n: license_scan.words_of(t) for n, t in license_scan.TEMPLATES.items()}


def test_alignment_is_common_and_rising():
    rng = random.Random(3)
    for _ in range(300):
        text = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 14))]
        template = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 10))]
        found = license_scan.align(text, template)
        assert all(text[i] == template[j] for i, j in found)
        assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:], strict=False))
        assert len(found) <= _longest_common(text, template)
    distinct = [str(i) for i in range(30)]
    shuffled = rng.sample(distinct, 30)
    assert len(license_scan.align(shuffled, distinct)) == _longest_common(shuffled, distinct)


def _longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("name", SPLIT)
def test_every_template_in_a_long_text(name):
    rng = random.Random(name)
    noise = [rng.choice(["the", "license", "of", "and", "this", "work", "permission", "zeta", "copies"]) for _ in range(3000)]
    text = " ".join(noise[:1500]) + "\n" + license_scan.TEMPLATES[name] + "\n" + " ".join(noise[1500:])
    found = {f[0]: f for f in license_scan.scan(text, SPLIT)}
    assert found[name][1] == 1.0 and found[name][3] - found[name][2] + 1 >= len(SPLIT[name])


def test_small_changes_and_other_texts():
    changed = license_scan.TEMPLATES["MIT"].replace("person", "body").replace("charge", "fee").upper()
    assert license_scan.scan(changed, SPLIT)[0][0] == "MIT"
    assert license_scan.scan("the license of this work and the text of it", SPLIT) == []
    assert license_scan.scan(" ".join(sorted(SPLIT["MIT"])), SPLIT) == []


def test_query(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-name",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0-short",
        "Released under the MIT License.": "MIT-name",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_license_scan"](spark, SF).collect():
        want = sorted({name for line, name in lines.items() if line in docs[r.doc_id].split("\n")})
        assert sorted(filter(None, r.licenses.split(","))) == want and (r.license in want if want else r.license is None)


def test_edges(edge_docs, no_docs):
    rows = license_scan.scan_licenses(edge_docs).collect()
    assert len(rows) == edge_docs.count() and {r.license for r in rows} == {None} and {r.kept for r in rows} == {"mine"}
    assert license_scan.scan_licenses(no_docs).collect() == []
    assert {tuple(r.licenses) for r in license_scan.scan_licenses(edge_docs, {}).collect()} == {()}


@pytest.mark.parametrize("name", SPLIT)
@pytest.mark.parametrize("copies", [2, 5])
def test_copies_close_together(name, copies):
    notice = license_scan.TEMPLATES[name]
    other = [f"word{i}" for i in range(20)]
    for between in ("\n", "\nand\n"):
        text = " ".join(other) + "\n" + between.join([notice] * copies) + "\n" + " ".join(other)
        found = {f[0]: f for f in license_scan.scan(text, SPLIT)}
        assert found[name][1] == 1.0
        assert words_at(text, found[name]) == SPLIT[name]
    changed = " ".join([*SPLIT[name][:1], "inserted", *SPLIT[name][1:]])
    if len(SPLIT[name]) >= 5:
        assert name in {f[0] for f in license_scan.scan(" ".join([*other, changed, changed, *other]), SPLIT)}


def words_at(text, found):
    return license_scan.words_of(text)[found[2] : found[3] + 1]
