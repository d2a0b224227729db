import pytest

from inkwell.llm import defects, refusals

EN = ["The liver keeps the level of glucose steady in most patients.", "Only the older women showed a rise in pressure after the dose.", "We followed the children for three years and found no change.", "A higher dose leads to a smaller effect in the kidney."]
DE = ["Die Leber hält den Zucker bei den meisten Patienten stabil.", "Nur die älteren Frauen zeigten nach der Gabe einen höheren Druck.", "Wir haben die Kinder über drei Jahre begleitet und nichts gefunden.", "Eine höhere Gabe führt zu einer kleineren Wirkung in der Niere."]
FR = ["Le foie maintient le sucre chez la plupart des patients.", "Seules les femmes âgées ont montré une pression plus élevée.", "Nous avons suivi les enfants pendant trois ans sans rien trouver.", "Une dose plus élevée entraîne un effet plus faible dans le rein."]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in EN] + [(t, "ger") for t in DE] + [(t, "FR") for t in FR] + [(None, "en"), ("x", None)])]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


CASES = [
    ("What does the liver do in the patients?", EN[0] + " " + EN[1], None),
    ("What does the liver do in the patients?", None, "empty"),
    ("What does the liver do in the patients?", "  \n", "empty"),
    ("What does the liver do in the patients?", "N/A", "empty"),
    ("What does the liver do in the patients?", "[empty]", "empty"),
    ("What does the liver do in the patients?", "what does the liver do in the patients", "copied_question"),
    ("What does the liver do in the patients?", "Question: What does the liver do in the patients?", "copied_question"),
    ("What does the liver do in the patients?", "What does the liver do in the patients? " + EN[0], None),
    ("What does the liver do in the patients?", "I'm sorry, but I cannot answer this question. Please consult a specialist.", "refusal"),
    ("What does the liver do in the patients?", EN[0] + " I cannot answer this question.", None),
    ("Was macht die Leber bei den Patienten?", "Ich kann diese Frage leider nicht beantworten.", "refusal"),
    ("What does the liver do in the patients?", DE[0] + " " + DE[1], "other_language"),
    ("What does the liver do in the patients?", f"{EN[0]} (« {FR[0]} {FR[2]} »).", None),
    ("Was macht die Leber bei den Patienten?", DE[0] + " " + DE[2], None),
    ("Was macht die Leber bei den Patienten?", FR[0] + " " + FR[2], "other_language"),
    ("What does the liver do in the patients?", EN[0] + " Only the older wom", "truncated"),
    ("What does the liver do in the patients?", EN[0] + " Only the older women,", "truncated"),
    ("What does the liver do in the patients?", EN[0] + " Only the older of the...", "truncated"),
    ("What does the liver do in the patients?", EN[0][:-1] + " (n = 34)", None),
    ("What does the liver do in the patients?", "AbcD3, not Xyz.", None),
    ("What does the liver do in the patients?", "412 units", None),
    ("What does the liver do in the patients?", "Because AbcD3 sharp", "truncated"),
    ("What does the liver do in the patients?", "MvwC, not gwaC.", None),
    (None, DE[0] + " " + DE[1], None),
]


def test_types(spark, rows_of, labelled):
    filler = [(1_000 + i, None, " ".join(EN[i % 4 :] + EN[: i % 4])) for i in range(40)] + [(2_000 + i, None, " ".join(DE[i % 4 :] + DE)) for i in range(20)] + [(3_000 + i, None, " ".join(FR)) for i in range(20)]
    rows = [(i, q, a, "clash") for i, (q, a, _) in enumerate(CASES)] + [(*f, "clash") for f in filler]
    df = spark.createDataFrame(rows, "qa_id bigint, question string, answer string, defect string")
    got = dict(rows_of(defects.defects(df, labelled)))
    assert {i: got.get(i) for i in range(len(CASES))} == {i: d for i, (_, _, d) in enumerate(CASES)}
    assert not set(got) - set(range(len(CASES)))
    assert defects.defects(df.filter("false"), labelled).count() == 0
    # Without labelled texts nothing is foreign, the rest is found.
    bare = dict(rows_of(defects.defects(df, labelled.filter("false"))))
    assert "other_language" not in bare.values() and bare[1] == "empty"


def test_held_out_languages(spark, labelled):
    model, _ = defects.fit_languages(labelled, "text", "lang", "doc_id")
    assert model.names == ["de", "en", "fr"]
    held = {"en": "There is no clear effect of the dose in these patients.", "de": "Bei diesen Patienten gibt es keine klare Wirkung.", "fr": "Il n'y a pas d'effet clair chez ces patients."}
    assert all(model.names[int(model.scores(t).argmax())] == lang for lang, t in held.items())


def test_very_long_answer(spark, labelled):
    df = spark.createDataFrame([(1, "What?", " ".join(EN) * 5_000)], "qa_id bigint, question string, answer string")
    assert defects.defects(df, labelled).count() <= 1


PARAPHRASES = [
    "I'd rather keep quiet about dosing.", "That question is one I have to turn down.", "Sorry, this isn't something I'm able to get into.", "I have no answer to give you. Talk to a nurse.", "We can't go into that here.",
    "My terms of use forbid an answer to this.", "It wouldn't be right for me to guess about your symptoms.", "Someone with medical training should answer this; I won't.",
    "Dazu gebe ich keine Antwort.", "Bedaure, dabei kann ich nicht weiterhelfen.", "Je préfère ne rien dire sur ce sujet.", "Désolé, je ne peux pas vous renseigner.",
    "Prefiero no opinar sobre ese asunto.", "Lo siento, no me está permitido contestar.", "Não me sinto em condições de responder a isso.", "Non mi sento di rispondere a questa domanda.", "Mi spiace, non posso esprimermi su questo.", "抱歉，这个问题我不方便回答。",
]
ANSWERS = [
    "We could not detect any difference between the groups.", "I do not know of a larger trial; the effect was small.", "No.", "It cannot be excluded that the dose was too low.", "Patients should consult a doctor if the fever lasts.", "The authors declined to give exact numbers for the second site.",
    "Wir konnten keinen Effekt nachweisen.", "Nous n'avons pas pu mesurer la fièvre.", "No se observó ningún cambio.", "Não foi possível medir o peso.", "Non è stata osservata alcuna differenza.", "我们没有观察到差异。", "The policy does not allow smoking on the ward.", "Because insulin lowers glucose.", "AbcD3, not Xyz.", "12 weeks",
]


def test_refusals_in_other_words():
    """Wordings that no grammar writes; a statement with a negation or a doctor in it is none."""
    model = refusals.fit_refusals()
    told = set(refusals.written()[0])
    assert not told & set(PARAPHRASES)
    found = [p for p in PARAPHRASES if model.is_refusal(p)]
    assert len(found) >= 0.8 * len(PARAPHRASES), set(PARAPHRASES) - set(found)
    assert [a for a in ANSWERS if model.is_refusal(a)] == []


def test_refusals_held_out():
    declining, stating = refusals.written(60, seed=99)
    model = refusals.fit_refusals()
    assert sum(model.declines(s) > 0.5 for s in declining) >= 0.98 * len(declining)
    assert sum(model.declines(s) < 0.5 for s in stating) >= 0.98 * len(stating)


def test_counts_beyond_four_bytes(spark):
    """The ending model counts in eight bytes, and adds up tables of many tasks."""
    df = spark.createDataFrame([(" ".join(EN),)] * 40, "a string").repartition(24)
    model = defects.fit_endings(df, "a")
    assert model.all.dtype.itemsize == 8 and model.all[0].sum() == 40 * (len(" ".join(EN)) - 1) and model.ends[0].sum() == 40 * 3
