import pytest

from pagewright.llm import pii

CASES = [
    ("Pište na ondrej.rokrad (at) obec-lhota.example.", {("email", "ondrej.rokrad (at) obec-lhota.example")}),
    ("Kontakt: [zde](mailto:JAN_NOVY@mail.lhota.example)", {("email", "JAN_NOVY@mail.lhota.example")}),
    ("jan.novy zavináč lhota tečka example", {("email", "jan.novy zavináč lhota tečka example")}),
    ("Snímky označte @lhotecka, 41 ks @ 356 Kč", set()),
    ("Volejte (+420) 438 321 830 v pracovní dny.", {("phone", "(+420) 438 321 830")}),
    ("Bližší údaje na čísle 664/455638, linka správce.", {("phone", "664/455638")}),
    ("Tel.: 651\xa0073\xa0308", {("phone", "651\xa0073\xa0308")}),
    ("Datová zpráva č. 672221564 byla doručena, IČO 84997364.", set()),
    ("Na účet č. 8496-193138810/0000 lze přispět.", set()),
    ("Rodné číslo 680923/6148 bylo uvedeno.", {("id_number", "680923/6148")}),
    ("Spis SZ 182163/2022 se vyřizuje.", set()),
    ("Totožnost ověřena podle dokladu OP č. 205818839. 1. Snímky", {("id_number", "205818839")}),
    ("Bydliště: ul. Pod Hvomysem 16a, 744 41 Lhota", {("address", "Pod Hvomysem 16a")}),
    ("Dům na adrese Lhotecká č. p. 719/69 projde kontrolou.", {("address", "Lhotecká č. p. 719/69")}),
    ("Trvale bytem nám. Rokdnorů 12.", {("address", "nám. Rokdnorů 12")}),
    ("Odpověď zašlete na adresu Lhota Usnesení č. 399/2021 schvaluje záměr.", set()),
    ("Ulice Petra Novotného v městské čtvrti bude jednosměrná, úprava náměstí začne 21. 1. 2024.", set()),
    ("Rozhodnutí podepsal(a) Ing. Radovoj Ostrukol, Ph.D., vedoucí.", {("person", "Radovoj Ostrukol")}),
    ("Zapsal(a): OSTRUKOL Radovoj", {("person", "OSTRUKOL Radovoj")}),
    ("Podle M. Mruhrana je most bezpečný. Pan Vrbdnor požádal.", {("person", "M. Mruhrana"), ("person", "Vrbdnor")}),
    ("Žádost podal Ludvík Svoboda, nar. 1. 2. 1990.", {("person", "Ludvík Svoboda")}),
    ("Podle Bořivoje Hrubého je most bezpečný. Zapsala: Zora Bílá", {("person", "Bořivoje Hrubého"), ("person", "Zora Bílá")}),
    ("Antrag von Herrn Wolfgang Schmidt. Signed by Emily Watson, mayor.", {("person", "Wolfgang Schmidt"), ("person", "Emily Watson")}),
    ("Die Gemeinde Lhota informiert. Spor mezi obcí a Dolní Lhotou skončil. Podle Dolní Lhoty je most bezpečný.", set()),
    ("Účet CZ65 0800 0000 1920 0014 5399 a karta 4111 1111 1111 1111.", set()),
    ("Volejte +420 4111 1111 1111 11, volejte 00420 602 111 222 12 hodin.", {("phone", "00420 602 111 222")}),
    (f"{'a' * 300}.novak@{'b' * 300}.cz", {("email", f"{'a' * 300}.novak@{'b' * 300}.cz")}),
    ("Setkání s Evou Hvobelovou Zábržerovou proběhne v sále.", {("person", "Evou Hvobelovou Zábržerovou")}),
]


@pytest.mark.parametrize(("text", "wanted"), CASES)
def test_cases(text, wanted):
    assert {(kind, text[s:e]) for s, e, kind in pii.spans(text)} == wanted


def test_blanks_around_the_sign():
    text = "Pište na petr.zhorad @ kamezvaloves.example nebo eva@\xa0obec-lhota.example, 20 ks @ 680 Kč, 3 ks @ 680.50 Kč, označte @lhotecka."
    assert [text[s:e] for s, e, kind in pii.spans(text) if kind == "email"] == ["petr.zhorad @ kamezvaloves.example", "eva@\xa0obec-lhota.example"]


def test_checksums():
    assert pii.birth_number("6809236148") and not pii.birth_number("6809236149") and not pii.birth_number("6813236148")
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.iban("CZ65 0800 0000 1920 0014 5399") and not pii.iban("CZ66 0800 0000 1920 0014 5399")


def test_find_and_mask(spark):
    rows = [(1, "Volejte 650 109 428.", "x"), (1, "Volejte 650 109 428.", "x"), (2, None, None), (3, "", None), (4, "slovo " * 100_000 + "Pan Vrbdnor žádal.", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, pii_type string")
    assert sorted(tuple(r) for r in pii.find(df).collect()) == [(1, "phone", "650 109 428"), (4, "person", "Vrbdnor")]
    out = {r.doc_id: r for r in pii.masked(df).collect()}
    assert out[1].text == "Volejte <PHONE>." and out[2].text is None and out[3].text == "" and out[4].text.endswith("Pan <PERSON> žádal.")
    assert pii.find(df.limit(0)).count() == 0 and pii.counts(df).count() == 2


@pytest.mark.parametrize("given", ["Ludvík", "Bořivoj", "Zora", "Wolfgang", "Emily", "Ctirad", "Radmila", "Oleksandr", "Thorsten", "Nguyen"])
def test_given_names_that_no_list_has(given):
    assert given not in pii._GIVEN
    for surname in ("Svoboda", "Hrubá", "Kovářová"):
        name = f"{given} {surname}"
        for text in (f"Rozhodnutí podepsal(a) {name}.", f"Žadatel: {name}, r. č. 680923/6148, předložil doklady.", f"| {name} | 602 111 222 |", f"Smlouva se uzavírá s občanem {name} na dobu neurčitou.", f"Kontakt: {name}, tel. 602 111 222"):
            assert ("person", name) in {(k, text[s:e]) for s, e, k in pii.spans(text)}, text


def test_checksums_refute(monkeypatch):
    text = "Platba kartou 4111111111111111, převod CZ6508000000192000145399, volejte 602 111 222."
    assert [k for *_, k in pii.spans(text)] == ["phone"]
    account = "Zaplaťte na CZ65 0800 0000 1920 0014 5399"
    assert pii.spans(account) == []
    monkeypatch.setattr(pii, "iban", lambda t: False)
    assert [account[s:e] for s, e, _ in pii.spans(account)] == ["0014 5399"]
