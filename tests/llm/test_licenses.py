import re

from vigia.llm import licenses
from vigia.llm.queries import op3_licenses

from .conftest import SMALL


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def same(rows, texts):
    for r in rows:
        assert plain(texts[r.doc_id]) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels), r
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_query_equals_brute_force(spark, docs):
    got = op3_licenses(spark, SMALL).collect()
    assert len(got) == docs.count()
    same(got, {r.doc_id: r.text for r in docs.collect()})


def test_places_and_notices(spark):
    notice = licenses.NOTICES[4][0]
    drifted = notice.replace("free of charge", "quite free of charge").replace("to any", "to really any")
    texts = {1: "MIT license mit LICENSE cc by", 2: "gnu general gnu general public license", 3: drifted,
             4: notice[:60], 5: "apache\nLicense; GNU general-public license, apache license", 6: "mit", 7: "ÀMIT license"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    same(got.values(), texts)
    assert got[3].labels == "mit" and got[3].n_base == 0 and got[3].score >= 0.8
    assert got[4].labels == "" and 0 < got[4].score < 0.8
    assert [tuple(s) for s in got[1].spans] == [(0, 1, "mit"), (2, 3, "mit"), (4, 5, "cc-by")]


def test_odd_rows(odd):
    got = licenses.scan(odd).collect()
    assert len(got) == odd.count()
    same([r for r in got if r.doc_id is not None], {r.doc_id: r.text for r in odd.collect()})
    assert licenses.scan(odd.limit(0)).count() == 0


def test_no_python_on_the_executors(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
