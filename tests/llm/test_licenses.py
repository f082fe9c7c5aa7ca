"""License scans against every run of words, whatever blocks the operator takes."""

import random
import re
from math import ceil

import pytest

from vulnloom.llm import licenses
from vulnloom.llm.license_texts import NOTICES
from vulnloom.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, blocks string, `a.b` int"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in texts], DOCS).repartition(3)


def words_of(text):
    return re.findall("[a-z0-9]+", text.lower())


def share(words, template):
    return len(set(words) & set(template)) / len(set(template))


def best(words, template, size):
    """Largest share of the template in any run of ``size`` words."""
    return max(share(words[s:s + size], template) for s in range(max(len(words) - size, 0) + 1))


def test_texts_wrapped_anywhere_are_found(spark):
    mit, bsd = NOTICES[8][1], NOTICES[6][1]
    wrapped = bsd.replace("with or without ", "with or without\n")
    texts = [(1, mit), (2, wrapped), (3, "w " * 300 + mit + " w" * 300), (4, "\n".join(words_of(mit))),
             (5, " ".join(words_of(mit)[:40]) + " w" * 60 + " ".join(words_of(mit)[40:60])), (6, None), (7, "")]
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert {i: r.labels for i, r in got.items()} == {1: "mit", 2: "bsd", 3: "mit", 4: "mit", 5: "mit", 6: "", 7: ""}
    only_whole = licenses.scan(docs_of(spark, texts), [("mit", mit)])
    assert {r.doc_id: (r.labels, r.score) for r in only_whole.collect()} == {
        1: ("mit", 1), 2: ("", 0), 3: ("mit", 1), 4: ("mit", 1), 5: ("", 0), 6: ("", 0), 7: ("", 0)}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_run_that_meets_the_threshold_is_found_and_no_other(spark, seed):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(30)]
    templates = [(f"t{k}", " ".join(rng.choice(common) if rng.random() < 0.5 else f"x{rng.randrange(60)}" for _ in range(n)))
                 for k, n in enumerate((1, 2, 3, 4, 5, 7, 13, 30, 64, 90))]
    texts = []
    for i in range(120):
        words = [rng.choice(common) for _ in range(rng.choice((0, 1, 5, 40, 300)))]
        for _ in range(rng.randrange(3)):
            own = words_of(rng.choice(templates)[1])
            kept = [w for w in own if rng.random() < rng.choice((0.7, 0.85, 1))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = kept
        texts.append((i, rng.choice((" ", "\n", ", ")).join(words)))
    got = {r.doc_id: r for r in licenses.scan(docs_of(spark, texts), templates).collect()}
    n_found = 0
    for i, text in texts:
        words, found = words_of(text), set(filter(None, got[i].labels.split(",")))
        for label, wording in templates:
            own = words_of(wording)
            near, far = ceil(round(len(own) / licenses.THRESHOLD, 9)), 2 * licenses.reach(len(own))
            if best(words, own, near) >= licenses.THRESHOLD:
                assert label in found
            if label in found:
                n_found += 1
                assert best(words, own, far) >= licenses.THRESHOLD and got[i].score >= licenses.THRESHOLD
    assert n_found > 50


def test_places_are_counted_from_the_one_before():
    words = ("the mit license " * 3 + "cc by nc cc by nc the mit license").encode().split()
    want = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.encode().split()]
    assert licenses.base_places(words) == want and len(want) == 6


def test_very_long_repeated_and_empty(spark):
    long = "word " * 400_000 + "released under the MIT license"
    rows = licenses.scan(docs_of(spark, [(1, long), (1, long), (None, "the mit license")])).collect()
    assert [(r.doc_id, r.n_words, r.labels, r.score) for r in rows] == [(1, 400_005, "mit", 1.0)] * 2
    assert licenses.scan(docs_of(spark, [(1, "x")]).limit(0)).count() == 0


def test_the_query_takes_whole_base_phrases(spark, tmp_path):
    texts = [(1, "Released under the MIT License."), (2, "the MIT license"), (3, "under the mit license, under\nthe MIT License"),
             (4, "underé the mit license"), (5, "Apache License, Version 2.0 or CC BY-NC 4.0"), (6, None)]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op10_license_scan"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == [
        (1, 5, 1, 1, 1, "mit"), (2, 3, 0, None, None, ""), (3, 8, 2, 0, 4, "mit"), (4, 4, 0, None, None, ""),
        (5, 11, 2, 0, 6, "apache-2,cc-by-nc"), (6, 0, 0, None, None, "")]


def test_the_query_labels_the_phrase_without_its_first_word(spark, tmp_path):
    import duckdb

    long = "word " * 300
    texts = [(1, "See the MIT license."), (2, f"{long} terms of the\nMIT License {long}"), (3, "under the MIT License; the mit license"),
             (4, "the mit licence"), (5, "see the mit\n\nlicense. CC BY-NC"), (6, "All rights reserved, the MIT license"), (7, None)]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_license_scan"](spark, str(tmp_path))
    rows = sorted(map(tuple, found.collect()))
    assert rows == [
        (1, 4, 0, None, None, "", "mit", 1.0, 1, 1, 1, "mit"),
        (2, 605, 0, None, None, "", "mit", 1.0, 1, 302, 302, "mit"),
        (3, 7, 1, 0, 0, "mit", "mit", 1.0, 2, 1, 4, "mit"),
        (4, 3, 0, None, None, "", "", 0.0, 0, None, None, ""),
        (5, 7, 1, 4, 4, "cc-by-nc", "cc-by-nc,mit", 1.0, 2, 1, 4, "cc-by-nc,mit"),
        (6, 6, 0, None, None, "", "all-rights-reserved,mit", 1.0, 1, 3, 3, "mit"),
        (7, 0, 0, None, None, "", "", 0.0, 0, None, None, "")]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(ORACLES["op10_license_scan"])
    assert [d[0] for d in sql.description] == found.columns and sorted(sql.fetchall()) == rows
