import itertools

import pytest
from pyspark.sql import functions as F

from riskloom.constants import BASE_SCORE, MAX_SCORE, RISK_TERM_WEIGHTS, UNKNOWN_ENTITY
from riskloom.functions import numbers as N
from riskloom.functions import text as X
from riskloom.operators import items as I
from riskloom.operators import results as R
from riskloom.operators import scoring as S
from riskloom.operators import teacher as TE

ITEM = "id long, title string, text_fragment string, entity_norm string"


def test_entities(spark):
    df = spark.createDataFrame([
        (1, "Сбер запустил сервис", "и ВТБ тоже", None), (2, "Новости", "банк втб и Сбербанк", None),
        (3, "Погода", "без банка", None), (4, "ВТБ", "", "  Газпромбанк "), (5, None, "Росбанк", " "),
    ], ITEM)
    got = {r.id: r.entity_norm for r in I.resolve_entity(df).collect()}
    assert got == {1: "Сбербанк", 2: "ВТБ", 3: UNKNOWN_ENTITY, 4: "Газпромбанк", 5: "Росбанк"}


def test_entity_tie_goes_to_the_first_in_the_dictionary(spark):
    df = spark.createDataFrame([(1, "abc", "", None)], ITEM)
    assert I.match_entity(df, {"Two": ["ab"], "One": ["abc"]}).first().entity_match == "Two"


def test_keyword_scores_of_all_term_sets(spark):
    terms = list(RISK_TERM_WEIGHTS)[:7]
    sets = [c for n in range(len(terms) + 1) for c in itertools.combinations(terms, n)]
    df = spark.createDataFrame([(i, " ".join(s).upper(), "", "") for i, s in enumerate(sets)], ITEM)
    got = {r.id: r for r in S.apply_threshold(S.keyword_risk_score(df)).collect()}
    for i, s in enumerate(sets):
        text = " ".join(s)
        cents = round(BASE_SCORE * 100) + sum(round(w * 100) for t, w in RISK_TERM_WEIGHTS.items() if t in text)
        want = min(round(MAX_SCORE * 100), cents) / 100
        assert got[i].risk_score == pytest.approx(want) and got[i].alert_flag == int(want >= 0.5)


def test_flag_comes_from_the_unrounded_score(spark):
    row = S.apply_threshold(spark.createDataFrame([(0.4999999,)], "score double")).first()
    assert (row.risk_score, row.alert_flag) == (0.5, 0)


def test_card_and_trim(spark):
    df = spark.createDataFrame([(1, "t", "E", "x" * 351, 0.8964, 1)],
                               "news_item_id long, title string, entity_norm string, text_fragment string, risk_score double, alert_flag int")
    card = I.result_card(df).first()
    assert (len(card.preview), card.has_more, card.score_text, card.label_text) == (350, True, "0.896", "risk")
    row = spark.createDataFrame([("\t  a b \n",)], "c string").select(X.trim_ws("c").alias("t"), X.word_count("c").alias("n")).first()
    assert (row.t, row.n) == ("a b", 2)


def test_char_grams_match_the_definition(spark):
    def grams(word):
        w = f" {word} "
        out = []
        for n in (3, 4, 5):
            out += [w[i:i + n] for i in range(len(w) - n + 1)]
        return sorted(out)
    for word in ("а", "аб", "абв", "слово"):
        got = spark.createDataFrame([(word,)], "w string").select(X.char_grams(F.col("w"), 3, 5)).first()[0]
        assert sorted(got) == grams(word)


def test_teacher_answers(spark):
    raws = ['{"label": 1, "confidence": 0.9}', 'so: {"label": "0", "confidence": "1.7"} ok', "nothing", '{"label": 2, "confidence": 0.5}',
            '{"label": 1}', None, '{"label": 1, "confidence": -3}', '{"label": 1.7, "confidence": 0.5}', '{"label": "1.7", "confidence": 0.5}',
            '{"label": -0.4, "confidence": 0.5}', '{"label": 1e30, "confidence": 0.5}']
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = [(r.teacher_label, r.teacher_confidence, r.teacher_reason) for r in TE.parse_teacher_json(df).orderBy("i").collect()]
    assert got == [(1, 0.9, "ok"), (0, 1.0, "ok"), (-1, None, "no json"), (-1, None, "bad label"), (-1, None, "bad confidence"),
                   (-1, None, "no json"), (1, 0.0, "ok"), (1, 0.5, "ok"), (-1, None, "bad label"), (0, 0.5, "ok"), (-1, None, "bad label")]
    answers = ["1", "Answer: 0.", "10", "класс1", None, "no 1 or 0"]
    rows = spark.createDataFrame(list(enumerate(answers)), "i int, a string").orderBy("i").select(N.parse_binary_answer("a")).collect()
    assert [r[0] for r in rows] == [1, 0, -1, -1, -1, 1]


def test_strict_join_refuses_repeated_keys(spark):
    train = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "sample_id long, alert_flag int")
    teacher = spark.createDataFrame([(1, 1, 0.9), (2, -1, None), (4, 0, 0.8)], "sample_id long, teacher_label int, teacher_confidence double")
    assert [r.sample_id for r in TE.attach_teacher(train, teacher).collect()] == [1]
    with pytest.raises(ValueError, match="not unique"):
        TE.attach_teacher(train, teacher.unionByName(teacher))
    soft = TE.with_soft_labels(TE.attach_teacher(train, teacher), 0.5).first()
    assert soft.teacher_soft_y == pytest.approx(0.9) and soft.soft_y == pytest.approx(0.95)
    one = TE.expand_soft_rows(TE.with_soft_labels(TE.attach_teacher(train, teacher), 0.5)).collect()
    assert sorted((r.label, round(r.weight, 6)) for r in one) == [(0, 0.05), (1, 0.95)]


def test_owner_and_messages(spark):
    jobs = spark.createDataFrame([(1, 7), (2, 8)], "id long, user_id long")
    assert R.require_owned(jobs, 7, 1).count() == 1
    with pytest.raises(LookupError):
        R.require_owned(jobs, 7, 2)
    bodies = ['{"batch_id": 5}', '{"batch_id": "5"}', '{"batch_id": 5.5}', "x", '{"other": 1}', '{"batch_id": true}']
    got = R.parse_control_message(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert [r.batch_id for r in got] == [5, None, None, None, None, None]
    assert [r.error is None for r in got] == [True] + [False] * 5
