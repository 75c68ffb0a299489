import random

import pytest

from cellkpi.llm import language_id as lang
from cellkpi.llm.common import is_held_out, table

SAMPLES = {"en": "the cat sat on a mat and the dog", "fr": "le chat est sur une table et le chien"}


def plain_pieces(parser, text, sample):
    """Greedy longest pieces that occur in the sample, block by block."""
    shown = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in shown:
        shown = shown.replace("  ", " ")
    shown, sample, n = shown.lstrip().encode(), sample.encode(), 0
    for a in range(0, len(shown), lang.BLOCK):
        block, i = shown[a:a + lang.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and block[i:j] in sample:
                j += 1
            i, n = max(j - 1, i + 1), n + 1
    return n


def test_pieces_by_definition():
    parser, rng = lang.CrossParser(SAMPLES), random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choice("thecasonml urbdgiéx ,3T") for _ in range(rng.randint(0, 700))) for _ in range(3)]
        assert parser.pieces(texts).tolist() == [[plain_pieces(parser, t, SAMPLES[k]) for k in parser.languages] for t in texts]


def test_every_script_keeps_its_letters():
    """Samples in scripts of many letters beside Latin ones: each is its own language."""
    samples = {"en": "the river runs through the old town and the people walk along its banks every day " * 3,
               "de": "der fluss fließt durch die alte stadt und die menschen gehen jeden tag an seinem ufer " * 3,
               "zh": "河流穿过古老的城市人们每天沿着河岸散步在清晨的阳光里老人们打太极拳孩子们去学校读书",
               "ja": "川は古い町を流れて人々は毎日その岸辺を歩きます朝の光の中で子供たちは学校へ行きます",
               "ko": "강은 오래된 도시를 지나 흐르고 사람들은 매일 강가를 걷습니다 아침 햇살 속에서 아이들은 학교에 갑니다",
               "th": "แม่น้ำไหลผ่านเมืองเก่าและผู้คนเดินเลียบฝั่งทุกวันในแสงแดดยามเช้าเด็กๆไปโรงเรียน",
               "ru": "река течёт через старый город и люди гуляют по её берегам каждый день дети идут в школу"}
    asked = {"en": "people walk through the town", "de": "die menschen gehen durch die stadt", "zh": "人们在古老的城市散步孩子们读书",
             "ja": "子供たちは古い町を歩きます", "ko": "아이들은 오래된 도시를 걷습니다", "th": "ผู้คนเดินไปโรงเรียนในเมืองเก่า", "ru": "дети гуляют по городу каждый день"}
    parser = lang.CrossParser(samples)
    assert parser.predict(list(asked.values()))[0] == list(asked)
    assert parser.predict([samples[k] for k in samples])[0] == list(samples)


def test_a_long_first_text_leaves_room_for_the_others():
    text = lang._shares(["a" * 1000, "bb", "c" * 300, "d" * 300], 400)
    assert len(text) <= 400 and text.count("bb") == 1 and min(text.count(c) for c in "acd") > 100


def test_defined_cases():
    parser = lang.CrossParser(SAMPLES)
    names, score = parser.predict([None, "", "12 !?", "the dog and the cat", "une table sur le chat"])
    assert names == ["und", "und", "und", "en", "fr"]
    assert score[:3].tolist() == [0, 0, 0] and 0 < score[3] <= 1
    assert lang.CrossParser({}).predict(["the cat"])[0] == ["und"]
    same = lang.CrossParser({"b": "abc", "a": "abc"})
    assert same.predict(["abc"])[0] == ["a"]


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = lang.identify_language(docs, lang.learn(docs)).select("doc_id", "lang", "lang_pred", "score").collect()
    asked = [r for r in out if is_held_out(r.doc_id)]
    assert len(asked) > 150 and sum(r.lang == r.lang_pred for r in asked) >= 0.97 * len(asked)


def test_odd_documents(odd_docs, no_docs):
    samples = lang.learn(odd_docs)
    assert set(samples) <= {"en", "de", "fr"}
    out = lang.identify_language(odd_docs, samples).collect()
    assert len(out) == odd_docs.count() and {r.lang_pred for r in out if r.text in (None, "", " \n\t ")} == {"und"}
    assert lang.learn(no_docs) == {} and lang.identify_language(no_docs, {}).count() == 0


@pytest.mark.parametrize("chars", [10, 100])
def test_sample_is_bounded(spark, chars):
    docs = spark.range(500).selectExpr("id AS doc_id", "'some text ' || string(id) AS text", "if(id % 9 = 0, null, 'en') AS lang")
    assert len(lang.training_sample(docs, 7, chars)["en"]) <= chars
