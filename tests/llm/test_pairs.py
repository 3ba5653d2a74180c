from pagewright.llm import pairs

CASES = [
    (1, "Jak si vyřídím cestovní pas?", None, "empty"),
    (2, "Jak si vyřídím cestovní pas?", " ​\n", "empty"),
    (3, "Jak si vyřídím cestovní pas?", "<p></p>", "empty"),
    (4, "Jak si vyřídím cestovní pas?", "**N/A**", "empty"),
    (5, "rodný list", "**Rodny list**", "copy"),
    (6, "HUMAN: rodný list", "Otázka: rodný list\nOdpověď: rodný list", "copy"),
    (7, "Kolik to stojí?", "Dobrý den! Bohužel k tomuto tématu nemám žádné informace. Hezký den!", "refusal"),
    (8, "Wie beantrage ich das?", "Leider kann ich diese Frage nicht beantworten.", "refusal"),
    (9, "Kolik to stojí?", "Omlouvám se za předchozí odpověď. Poplatek činí 300 Kč a platí se kartou.", None),
    (10, "Kde podám žádost o rybářský lístek?", "You can apply for a fishing permit at counter 8.", "wrong_language"),
    (11, "Kde podám žádost? Odpovězte mi prosím anglicky.", "You can apply for a fishing permit at counter 8.", None),
    (12, "Jak si vyřídím pas?", "Stránka je i v angličtině, viz \"How to apply for a passport in the office\".", None),
    (13, "Jak si vyřídím pas?", "Vyřízení trvá obvykle 9 dní, o výsledku vás informujeme zprávou do da", "truncated"),
    (14, "Jak si vyřídím pas?", "Přineste si toto:\n- doklad totožnosti\n- ", "truncated"),
    (15, "Jak si vyřídím pas?", "Postup je na webu. [podrobný postup](https://www.", "truncated"),
    (16, "Jak si vyřídím pas?", "Vyřízení trvá obvykle 9 dní. (viz příloha č.", "truncated"),
    (17, "Jak si vyřídím pas?", "Volejte.\nTelefon: 651 073 308", None),
    (18, "Jak si vyřídím pas?", "Přineste si toto:\n- doklad totožnosti\n- formulář", None),
    (19, "Kolik?", "177 Kč", None),
    (20, None, "Poplatek činí 300 Kč a platí se kartou.", None),
    (21, "Je to zdarma?", "Ano.", None),
    (22, "Jak si vyřídím pas?", "Poplatek činí 300 Kč a platí se kartou. " * 5000, None),
]


def test_each_defect(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "pair_id bigint, question string, answer string")
    found = {r.pair_id: r.defect_type for r in pairs.defects(df.union(df)).collect()}
    assert found == {c[0]: c[3] for c in CASES if c[3]}


def test_all_triggers_and_empty_table(spark):
    df = spark.createDataFrame([(1, "rodný list?", "rodný list,")], "pair_id bigint, question string, answer string")
    assert {r.defect_type for r in pairs.all_defects(df).collect()} == {"copy", "truncated"}
    assert pairs.defects(df.limit(0)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "x?", None, "q", "a", 3)], "pair_id bigint, question string, answer string, q string, a string, rank int")
    assert pairs.defects(df).collect()[0].defect_type == "empty"


# phrasings that the rules' lists were not written from
REFUSALS = [
    "Tuhle otázku neumím zodpovědět.", "S tím vám bohužel neporadím.", "Na to nemám odpověď.", "O tom mi není nic známo.", "Bohužel netuším.", "To je nad rámec toho, co umím.",
    "Je mi líto, k dané věci nemám žádné údaje. Hezký den!", "Tady vám bohužel nepomůžu.", "Omlouvám se, informace o tomto poplatku nemáme.", "Na podobné dotazy neodpovídám.",
    "I am afraid I do not have an answer to that.", "Sorry, this question is beyond my scope.", "I can't help you with this.", "We are not able to assist you here.",
    "Dazu habe ich leider keine Auskunft.", "Diese Frage kann ich nicht beantworten.", "Das weiss ich nicht.", "Na túto otázku nepoznám odpoveď.", "S tým vám nepomôžem.", "Niestety nie znam odpowiedzi.",
]
SOUND = [
    "Bez dokladu totožnosti vám žádost nepřijmou. Vezměte si občanský průkaz.", "Poplatek se neplatí, nemusíte nic hradit.", "Nevíme přesně, kdy skončí oprava, ale úřad má otevřeno v pondělí do 17 hodin.",
    "Na tuto otázku odpovídá vyhláška č. 5: poplatek činí 300 Kč.", "Nemáte-li doklad, obraťte se na matriku v přízemí budovy.", "Ne, nelze.", "You cannot apply online; please come to counter 8.", "Nein, das ist nicht möglich. Kommen Sie bitte ins Rathaus.",
]
FOREIGN = {
    "fr": "Vous pouvez déposer votre demande à la mairie, le bureau est ouvert tous les jours sans rendez-vous.",
    "es": "Puede presentar la solicitud en el ayuntamiento, donde también se paga la tasa correspondiente.",
    "it": "La domanda deve essere presentata presso il comune, dove potete anche pagare la tassa.",
    "hu": "A kérelmet az önkormányzat hivatalában kell benyújtani, és az illetéket is ott lehet befizetni.",
    "nl": "U kunt de aanvraag bij de gemeente indienen, daar kunt u ook de kosten betalen.",
    "pt": "Você pode apresentar o pedido na câmara municipal, onde também se paga a taxa.",
    "ro": "Puteți depune cererea la primărie, unde trebuie să plătiți și taxa.",
    "hr": "Zahtjev možete predati u općini, gdje se plaća i pristojba, bez prethodne najave.",
}


def test_refusals_in_other_words():
    missed = [a for a in REFUSALS if "refusal" not in pairs.triggered("Jak si vyřídím cestovní pas?", a)]
    assert len(missed) <= 1, missed
    assert not [a for a in SOUND if "refusal" in pairs.triggered("Jak si vyřídím cestovní pas?", a)]


def test_languages_beyond_the_data():
    assert sum(pairs.guess_language(a) == k for k, a in FOREIGN.items()) >= 6
    assert not {pairs.guess_language(a) for a in FOREIGN.values()} & {"cs", "sk", "en", "de"}
    assert sum("wrong_language" in pairs.triggered("Jak si vyřídím cestovní pas v obci?", a) for a in FOREIGN.values()) >= 7


def test_the_first_trigger_counts():
    q = "Jak si vyřídím cestovní pas?"
    assert pairs.triggered(q, f"{q} Jak si vyřídím cest") == ["copy", "truncated"]
    assert pairs.triggered(q, "Unfortunately I cannot help you with this topic.")[0] == "refusal"
    assert pairs.triggered(q, "Řeknu to takto: " + "pas (viz příloha") == ["truncated"]
