import pytest

from reviewmart.llm import licences
from reviewmart.llm.common import find_package

#: text, families, confirmed statements.
CASES = [
    ("Dual: MIT License or Apache License, Version 2.0.", "apache-2.0,mit", 2),
    ("Prose first.\nLicensed under the Apache\nLicense, Version 2.0.\nMore prose.", "apache-2.0", 1),
    ("This work is licensed under the GNU\nGeneral Public License,\nversion 3.", "gpl", 1),
    ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl", 1),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", 1),
    ("Licensed under CC BY 4.0.\nLicensed under CC BY 4.0.", "cc-by", 2),
    ("He studied at the MIT\nand has a license to drive a car.", "", 0),
    ("The apache helicopter\n\nLicense fees apply.", "", 0),
    ("Released under the MIT License.\n\n   \n", "mit", 1),
    ("Released under the\r\nMIT License.", "mit", 1),
    ("  no sentence  is cut here", "", 0),
    ("", "", 0),
    (None, "", 0),
]


@pytest.fixture(scope="module")
def found(spark, documents):
    find_package(spark)
    rows = [(-1 - i, text, "x", "y") for i, (text, _, _) in enumerate(CASES)]
    given = spark.createDataFrame(rows, "doc_id long, text string, family string, confirmed string")
    return {r["doc_id"]: r for r in licences.scan(given.unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_statement(found, case):
    _, families, stated = CASES[case]
    row = found[-1 - case]
    assert (row["families"], row["n_licence"]) == (families, stated)


def test_either_join_gives_the_same(spark, documents, monkeypatch):
    texts = documents.select("doc_id", "text").where("text LIKE '%icense%' OR doc_id < 40")
    usual = sorted(map(tuple, licences.scan(texts).collect()))
    monkeypatch.setattr(licences, "BROADCAST_FOUND", -1)
    assert sorted(map(tuple, licences.scan(texts).collect())) == usual


def test_empty_table(documents):
    assert licences.scan(documents.where("false")).collect() == []


def test_columns_of_taken_names(spark):
    rows = [(1, "Released under the MIT License.", 3, "a", True), (1, "All rights reserved.", 3, "b", False), (None, None, 0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int, family string, confirmed boolean")
    found = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert found[1]["families"] == "mit,proprietary" and found[1]["n_lines"] == 2
    assert (found[None]["families"], found[None]["n_lines"]) == ("", 0)
