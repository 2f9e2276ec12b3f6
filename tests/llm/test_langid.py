import random
import zlib

from vigia.llm import langid
from vigia.llm.queries import op10_langid

from .conftest import SMALL


def test_held_out_accuracy(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = op10_langid(spark, SMALL).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) >= 0.98


def test_parsing_equals_brute_force():
    random.seed(6)
    samples = {n: ["".join(random.choice(a) for _ in range(300))] for n, a in (("x", "abcd e"), ("y", "cdef g"))}
    model = langid.build(samples)
    texts = ["", "abcde fg" * 300, "zzz", "abc def", "".join(random.choice("abcdefgh ") for _ in range(2500))]
    points = [langid.code_points(t) for t in texts]
    got = model.phrases(points)
    letters = {name: "".join(map(chr, langid.code_points(s[0]))) + " " for name, s in samples.items()}
    for i, p in enumerate(points):
        text = "".join(map(chr, p))
        for k, name in enumerate(model.languages):
            phrases = 0
            for at in range(0, len(text), langid.BLOCK):
                block, start = text[at:at + langid.BLOCK], 0
                while start < len(block):
                    end = start
                    while end < len(block) and block[start:end + 1] in letters[name]:
                        end += 1
                    phrases += 1
                    start = max(end, start + 1)
            assert got[i, k] == phrases, (texts[i][:20], name)


def test_automaton_spells_the_substrings():
    word = [0, 1, 0, 0, 1, 2, 0, 1]
    table = langid.suffix_automaton(word, 3)
    for a in range(3**4):
        path = [a // 3**k % 3 for k in range(4)]
        state = 0
        for c in path:
            state = table[state, c] if state >= 0 else -1
        assert (state >= 0) == any(word[i:i + 4] == path for i in range(len(word)))


def test_odd_rows(spark, odd):
    got = langid.predictions(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id in (0, 1, 2, 9):  # null, empty, blank, no letter
            assert r.lang_pred == "und" and r.score == 0
    assert langid.predictions(odd.limit(0)).count() == 0
    unlabelled = odd.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.predictions(unlabelled).collect()} == {"und"}


def test_code_points():
    assert "".join(map(chr, langid.code_points("  Ab12c,, É😀x "))) == "ab c é x "
    assert len(langid.code_points("")) == len(langid.code_points("!!")) == 0


def test_languages_of_many_letters():
    random.seed(4)
    letters = {"han": range(0x4E00, 0x4E00 + 400), "hangul": range(0xAC00, 0xAC00 + 400), "greek": range(0x3B1, 0x3C9)}
    words = {k: ["".join(chr(random.choice(v)) for _ in range(3)) for _ in range(150)] for k, v in letters.items()}
    text = lambda k, n: " ".join(random.choice(words[k]) for _ in range(n))
    model = langid.build({k: [text(k, 100) for _ in range(30 if k != "hangul" else 10)] for k in letters})
    assert len(model.alphabet) > langid.SYMBOLS and model.table.shape[1] == langid.SYMBOLS + 1
    for k in letters:
        names, scores = model.predict([text(k, 30) for _ in range(5)])
        assert set(names) == {k} and min(scores) > 0.2
