from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import text as T


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "t string").select(col(F.col("t")).alias("x")).first()[0]


def test_clean_text(spark):
    assert one(spark, T.clean_text, "Кот, ПЁС - и «мышь»: 3 (три) шт.!") == "кот пёс  и «мышь» 3 три шт"
    assert one(spark, T.clean_text, T.PUNCTUATION) == ""
    once = one(spark, T.clean_text, "A_b/C\\d e-f")
    assert once == "abcd ef" and one(spark, T.clean_text, once) == once


SENTENCES = [
    ("Кот спит на диване. Пёс сидит у двери! Кто там стучит? Никого нет дома.",
     ["Кот спит на диване.", "Пёс сидит у двери!", "Кто там стучит?", "Никого нет дома."]),
    ('Он крикнул: "Бегите все сюда!" Потом стало тихо.', ['Он крикнул: "Бегите все сюда!"', "Потом стало тихо."]),
    ("Др. Сидоров пришёл вовремя. Все были рады ему.", ["Др. Сидоров пришёл вовремя.", "Все были рады ему."]),
    ("Возьмём т.е. Пример из книги. Другой пример рядом.", ["Возьмём т.е. Пример из книги.", "Другой пример рядом."]),
    ("Первая строка текста\n\nВторая строка|\tтретья строка", ["Первая строка текста.", "Вторая строка. третья строка"]),
    ("Ура! Это длинное предложение здесь.", ["Это длинное предложение здесь."]),
    ("Он ушёл далеко... а потом вернулся.", ["Он ушёл далеко... а потом вернулся."]),
    ("", []), ("           ", []),
]


def test_split_sentences(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTENCES)], "i int, t string")
    got = [r.x for r in df.select("i", T.split_sentences(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == [want for _, want in SENTENCES]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["Река", "течёт", "вниз", ".", "!", "?", "\"", " ", "\n", "и.о.", "Гл.", "…", "|", "\t"]), max_size=30))
def test_sentences_are_pieces_of_the_text_in_order(spark, parts):
    text = " ".join(parts)
    rest = one(spark, T.normalize_breaks, text)
    for piece in one(spark, T.split_sentences, text):
        assert len(piece) > 10 and piece.strip(" ")
        before, found, rest = rest.partition(piece)
        assert found


PAGE = "<html><body><h1>Новый мост через реку</h1></body></html>"
# the marker table is one pattern: entities, then white space
MARKERS = [m for m in T.TITLE_SPLIT_MARKERS.removeprefix("(?U)").split("|") if m.startswith("&")]


def test_title_markers(spark):
    rows, want = [], []
    for mark in [*MARKERS, " ", "\t", "\n", "\x0b", "\x0c", "\r", "\u00a0", "\u2003", "\u3000"]:
        rows += [(len(rows), mark.join(["Новый", "мост", "через", "реку", ""]), PAGE),
                 (len(rows) + 1, PAGE[16:35], PAGE.replace(" ", mark)), (len(rows) + 2, "Старый" + mark + "мост", PAGE)]
        want += [True, True, False]
    df = spark.createDataFrame(rows, "i int, title string, html string")
    assert [r.ok for r in df.select("i", T.title_in_html(F.col("title"), F.col("html")).alias("ok")).orderBy("i").collect()] == want


def test_title_quot_and_backslash(spark):
    df = spark.createDataFrame([('Say &quot;hi&quot;', '<p>Say &quot;hi&quot;</p>'),
                                ('a\\b', '<p>ab</p>\\')], "title string, html string")
    assert all(r[0] for r in df.select(T.title_in_html(F.col("title"), F.col("html"))).collect())


def test_short_and_tokens(spark):
    df = spark.createDataFrame([("abc",), ("long enough",)], "t string")
    assert [r[0] for r in df.select(T.is_short_text(F.col("t"))).collect()] == [True, False]
    assert one(spark, T.whitespace_tokens, "  a  b\tc ") == ["a", "b", "c"]
