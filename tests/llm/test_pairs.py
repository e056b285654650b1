"""Problem 4: rules one by one, and the table."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import pairs
from pairloom.llm.lookalikes import canonical

GOAT = "What is the goat doing near the river?"


BROKEN = ["There are seven people standing behi", "Có lẽ là sáng sớm vì chi", "The wall cl", "Bác tài xế đang chờ xe buýt bên tro", "Der Kellner fegt den Boden und ble"]


class Judge:
    """The rules with all that the table operator gives them."""

    def __init__(self, spark):
        d = spark.read.parquet("/root/testdata/sf0.01/samples.parquet").select("row_index", "question", "answer")
        d = d.unionByName(spark.createDataFrame([(-i, GOAT, a) for i, a in enumerate(BROKEN, 1)], d.schema))
        self.model = pairs.fit_pairs(d, "row_index", "question", "answer")
        self.cuts = {r.fragment for r in pairs.fragments(d, "question", "answer").collect()}

    def __call__(self, question, answer):
        q, a = canonical(question, answer), canonical(answer, question)
        ws = pairs.words(a) if a else []
        return pairs.defects(q, a, self.model, bool(ws) and ws[-1] in self.cuts)


@pytest.fixture(scope="module")
def judge(spark):
    return Judge(spark)


@pytest.fixture(scope="module")
def model(judge):
    return judge.model


@pytest.mark.parametrize("answer", [None, "", " \t\n", "　", "​", "\x1c", "-", "--", "N/A", "n/a", "null", "None", "<empty>", "[no answer]", "No caption given.", "...", "…", "-" * 61, "." * 300, ". " * 40, "( N / A )", " ".join("[no   answer]".split())])
def test_empty(judge, answer):
    assert judge(GOAT, answer) == judge(None, answer) == ["empty"]


@pytest.mark.parametrize(
    "question, answer",
    [
        (GOAT, GOAT), (GOAT, GOAT.upper().replace(" ", "  ")), (GOAT, f'"{GOAT}"'), (GOAT, f"Question: {GOAT}"), (GOAT, "What is the doing near the river"), ("Đây là lúc nào trong ngày?", "Đây lúc nào trong ngày"),
        ("店員は何をしていますか？", "店員は何をしていますか"), ("Où se trouve la théière ?", "Où se la théière ?"), (GOAT, "> " + GOAT),
    ],
)
def test_copied(judge, question, answer):
    assert judge(question, answer)[0] == "copied_question"


@pytest.mark.parametrize(
    "answer",
    [
        "I'm sorry, but I can't help with that request.", "As an assistant, I cannot provide an answer to this question.", "Answering this would go against my guidelines.", "The sky is blue. Sorry, this is something I'd rather not comment on.",
        "Regrettably, no description of the driver can be given by me.", "Identifying the waiter is not something I can do.", "the policy I follow does not let me talk about such pictures.", "Tôi không thể trả lời câu hỏi này.",
        "Rất tiếc, việc nhận xét về cô gái không phù hợp với quy định.", "Lo siento, no me corresponde opinar sobre la jardinera.", "Désolé, il ne m'est pas permis de décrire cette image.", "identifier le vieil homme ne relève pas de mes fonctions.",
        "Leider gilt: dazu möchte ich mich nicht äußern.", "Es tut mir leid, diese Frage muss ich ablehnen.", "Извините, мне не разрешено описывать это изображение.", "申し訳ありませんが、このご質問にはお答えできません。", "I c​an't help with that request.",
        "回答を辞退いたします", "Kann dazu keine Auskunft geben", "Должен отклонить этот запрос", "The sky is blue. " * 400 + "I cannot help with that.",
    ],
)
def test_refusal(judge, answer):
    assert "refusal" in judge(None, answer)


@pytest.mark.parametrize(
    "answer",
    [
        "Sorry, we are closed: that is what the sign says.", 'The note reads "I won\'t be able to come" in red ink.', "I cannot see the goat anywhere; there is only the kite.", "The older man is unable to lift the swing, so a second person helps.",
        "A guard declined to help, so the driver is folding a map alone.", "I cannot tell the kite from the tram at first, but the red one is the kite.", 'Tấm biển ghi "Xin lỗi, hôm nay nghỉ bán".', "Je ne peux voir le chat nulle part ; il n'y a que le miroir à gauche.",
        "A small label under the tree cannot be read.", "No puedo ver el banco por ninguna parte; solo está el puesto.", "Ich kann die Katze nirgends sehen; da ist nur die Leiter.",
    ],
)
def test_no_refusal(judge, answer):
    assert judge(None, answer) == []


@pytest.mark.parametrize(
    "answer",
    [
        "The goat is near the river. The far end of the street is out of focus,", "The goat stands near the river next to a", "1. The goat.\n2. The kite.\n3)", "Only the handle is (lit", 'The ground is still "wet', "Bức ảnh được…", "Hai thứ ở góc trái là chiếc ô;",
        "There are seven people standing behi", "Có lẽ là sáng sớm vì chi", "Der ältere Herr faltet eine Karte neben einer", "red two, blue four, green", "The wall cl", "Bác tài xế đang chờ xe buýt bên tro", "Der Kellner fegt den Boden und ble",
    ],
)
def test_truncated(judge, answer):
    assert judge(None, answer) == ["truncated"]


@pytest.mark.parametrize(
    "answer",
    ["a red goat near the river", "the hay bale and the kite", "yes", "10:45", "B", "100 %", "wood.", '"the goat"', "đang chụp ảnh", "el cartel al otro lado de la plaza", "The goat is (really) here.", "a red\ngoat", "2", "el puesto de fruta", "The goat.​", "There are 12.", "There were 3)", "They are numbered 1 to 12."],
)
def test_whole(judge, answer):
    assert judge(None, answer) == []


@pytest.mark.parametrize(
    "question, answer, wrong",
    [
        (GOAT, "Le tramway près de la rivière.", True), (GOAT, "Велосипед под деревом", True), (GOAT, "自転車は柵の後ろにあります。", True), ("Chiếc ô nằm ở đâu trong bức ảnh?", "The clay teapot near the river", True), ("Où se trouve la chèvre ?", "Der Lieferwagen steht vor der Bäckerei.", True),
        ("How would a French caption name the object by the counter?", "le parapluie au bord du quai", False), (GOAT, "10:45", False), (GOAT, 'The sign says "Аптека" today.', False), ("Chiếc ô nằm ở đâu trong bức ảnh?", "Chiếc ô nằm ở góc trái.", False),
        (None, "Le tramway près de la rivière.", False), ("", "Le tramway près de la rivière.", False), (GOAT, "Thе gоаt іѕ еаtіng grаѕѕ.", False),
    ],
)
def test_language(judge, question, answer, wrong):
    assert ("wrong_language" in judge(question, answer)) == wrong


def test_table(spark, model):
    long = "The goat stands near the river. " * 20_000
    rows = [(1, GOAT, None, "x"), (1, GOAT, None, "x"), (2, None, None, None), (3, GOAT, "The goat is eating.", "x"), (4, GOAT, long, "x"), (5, GOAT, long + "And then,", "x"), (None, GOAT, GOAT, "x")]
    df = spark.createDataFrame(rows, "row_index bigint, question string, answer string, defects string")
    got = sorted(((r.row_index, r.defects[0]) for r in pairs.pair_defects(df, model=model).collect()), key=repr)
    assert got == sorted([(1, "empty"), (1, "empty"), (2, "empty"), (5, "truncated"), (None, "copied_question")], key=repr)
    assert pairs.pair_defects(df.limit(0)).count() == 0


def test_order_of_rules():
    assert pairs.DEFECTS == ("empty", "copied_question", "refusal", "truncated", "wrong_language")
    assert pairs.common_subsequence(list("abcde"), list("axcye")) == 3


@pytest.mark.parametrize("pattern, some", [("abc|de", {"abc", "de"}), (r"x?\w+(?:foo|bars)\b.{0,5}z", {"foo", "bars"}), (r"(?:a|b)?c", {"c", "ac", "bc"}), (r"\w+", set()), (r"(?:\w+|abc)", set()), (r"(?:\w+x|abc)d?", {"x", "abc"})])
def test_needed_literals(pattern, some):
    assert pairs.needed(pattern) == some


PARTS = ["i ", "can't ", "cannot ", "help", "answer ", "my ", "policy ", "against ", "rules ", "do not ", "let me", "tôi ", "từ chối ", "xin ", "no puedo ", "responder", "je ne peux ", "pas ", "vous ", "dire", "kann ", "dazu ", "nicht ", "keine ", "auskunft ", "geben",
         "lehne ich ab", "не могу ", "ответить", "должен ", "отклонить", "回答", "を", "辞退", "控え", "ません", "お答え", "でき", "x", " ", ". "]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=10).map("".join))
def test_looking_for_literals_loses_no_refusal(text):
    want = any(p.search(x) for x in pairs._SENTENCE_END.split(pairs._QUOTED.sub(" ", text)) for p in pairs._REFUSAL)
    assert pairs.is_refusal(text) == want


def test_rules_look_at_whole_texts():
    """Ends and beginnings of any length."""
    assert pairs.is_stopped("The goat." + "\"')] " * 30) and not pairs.is_stopped("goat " + "\"')] " * 30)
    assert pairs.ends_with_list_mark("1. a\n2. b\n  (13)") and pairs.ends_with_list_mark("a goat. \n   *") and not pairs.ends_with_list_mark("it is 12.")
    assert pairs.is_copy("where is it", "  " * 40 + "Question  : where is it")


def test_fragments(spark):
    """A rare word is no fragment only because it is rare; a piece is one however many rows there are."""
    whole = [("The category of the cat is told here.", "The cats sleep.")] * 5 + [("Who?", "a red cat"), ("Who?", "one dog")]
    broken = [("Who?", "in the categ")] * 4
    for times in (1, 50):
        df = spark.createDataFrame((whole + broken) * times + [(None, None), ("", ""), ("categories", "…")], "q string, a string")
        assert [r.fragment for r in pairs.fragments(df, "q", "a").collect()] == ["categ"]
    assert pairs.fragments(df.limit(0), "q", "a").count() == 0
