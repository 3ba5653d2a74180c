"""Personal information inside free text (problem 8): e-mail, phone, identity number, address, person.

Regular expressions propose spans, checksums confirm or refute them (modulo 11 confirms birth numbers; Luhn and
modulo 97 find the numbers of payment cards and accounts, whose digits are no phones), and words next to a span
change its score. Names come from a list of given names, and any two capital words may be one if the words around
them, titles and the shape of the surname say so. Spans that reach ``ACCEPTED`` are kept; of two that overlap,
the one of the earlier type in ``ORDER``.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Score from which on a span is kept.
ACCEPTED = 1.0
ORDER = ("email", "id_number", "phone", "address", "person")
PLACEHOLDERS = {"email": "<EMAIL>", "id_number": "<ID_NUMBER>", "phone": "<PHONE>", "address": "<ADDRESS>", "person": "<PERSON>"}
#: Characters before and after a span that are looked at for context.
CONTEXT = 48

# Common given names in the nominative; the other cases follow from rules.
GIVEN = """
Adam Adéla Adolf Alena Aleš Alexander Alexandra Alice Alois Alžběta Andrea Andrej Anežka Anna Antonín Barbora Bedřich Blanka Bohumil Bohumila
Božena Břetislav Dagmar Dalibor Dana Daniel Daniela David Denisa Dominik Dominika Drahomíra Dušan Eduard Eliška Emil Ema Erik Eva Filip František
Františka Gabriela Hana Hans Helena Ivan Ivana Iveta Ivo Jakub Jan Jana Jarmila Jaromír Jaroslav Jaroslava Jindřich Jiří Jiřina Jitka John Josef
Jozef Julie Kamil Kamila Karel Karolína Kateřina Klára Kristýna Květa Ladislav Lenka Leoš Libor Libuše Lubomír Lubor Lucie Luboš Lukáš Ludmila Magdaléna
Marcela Marek Marie Markéta Martin Martina Matěj Michael Michal Michaela Milada Milan Milena Milodara Miloš Miloslav Miloslava Miroslav Miroslava Monika Naděžda Natálie
Nikola Oldřich Olga Ondřej Otakar Pavel Pavla Pavlína Peter Petr Petra Radek Radka Radim Radovoj Renata René Richard Robert Roman Romana Rostislav
Rudolf Růžena Šárka Šimon Simona Stanislav Stanislava Štěpán Štěpánka Tereza Tomáš Vaclav Václav Věra Veronika Viktor Vít Vítězslav Vladimír Vladimíra Vlasta
Vlastana Vlastimil Vojtěch Zdeněk Zdeňka Zdimír Zuzana Žaneta
"""  # fmt: skip
# Titles before and after names, forms of address, words of streets.
TITLE = r"(?:Ing\. ?arch|Ing|Mgr|MgA|Bc|BcA|JUDr|MUDr|MVDr|MDDr|PhDr|RNDr|PaedDr|PharmDr|ThDr|ThLic|doc|Doc|prof|Prof|Dr|Dipl\.-Ing|akad|plk|mjr|kpt|por|gen|arch)\.?"
# Words before and after names of people, in Czech, Slovak, German and English.
_TAIL = r"(?:\s(?:zůstává|ostáva|je|byl\w*|is|was|ist))?\s*(?:\([^()]{1,12}\))?\s*[:\-–]?\s*$"
PERSON_WORD = re.compile(
    r"(?i)(?<!\w)(?:(?:podal|podepsal|zapsal|vypracoval|schválil|uvedl|sdělil|řekl|dodal|připravil|napsal|ověřil|předložil|vyřídil|navrhl|podpísal|zapísal|uviedol|povedal)(?:\(a\)|a|i)?"
    r"|(?:jednatel|starost|místostarost|hejtman|ředitel|tajemní[kc]|tajemnic|referent|zastupitel|občan|host|autor|žadatel|žiadate[lľ]|majitel|vlastník|nájemc|nájemník|kupující|prodávající|svěd[ek]|pacient|žá[kc]|správc|předsed|riadite[lľ]|účastní[kc])\w*"
    r"|vedoucí\w*|radn[íé]\w*|mayor|author|applicant|resident|signed by|gezeichnet|unterzeichnet|bürgermeister\w*|ansprechpartner\w*|antragsteller\w*)" + _TAIL
)
BEFORE_NAME = re.compile(
    r"(?i)(?<!\w)(?:kontakt\w*|odpovíd[áa]|poskyt\w+|zůstává|ostáva|vyřizuje|vybavuje|zastupuje|zastoupen\w*|podle|dle|podľa|jménem|menom|mezi (?:\w+ ){1,3}a|medzi (?:\w+ ){1,3}a|hovořil\w* s|setkání s|stretnutie s"
    r"|by|contact|according to|said|between (?:\w+ ){1,3}and|von|durch|mit|erteilt|laut|zwischen (?:\w+ ){1,3}und)" + _TAIL
)
BORN = re.compile(r"(?i)^,?[  ]?\(?(?:nar\.|narozen|r\. ?č|rodné č|geb\.|geboren|born|ph\. ?d|csc|dis\.)|^(?:[,;]|[  ]?\|)[  ][\w.+-]+[  ]?(?:@|\(at|\[at|zavin)|^[  ]?\|[  ]*[+(]?\d{3}")
AFTER_NAME = re.compile(
    r"(?i)^(?:[,;]?[  ](?:mba|tel\b|telefon|mobil|e-?mail|bytem|trvale|dveře|mayor|starost|místostarost|vedoucí|ředitel|jednatel|tajemn|bürgermeister)"
    r"|[  ]?\|[  ]*(?:[+(]|\d{2}|[\w.]+[  ]?[@(\[])|[,;][  ][\w.+-]+[  ]?(?:@|\(|\[|zavin)|\n\s*(?:tel\b|telefon|mobil|e-?mail|[+(]?\d{3})"
    r"|[  ](?:požádal|požiadal|uvedl|řekl|podepsal|předložil|žádá|žiada|bydlí|býva|zůstává|převádí|said|signed|lives|resides|or call|wohnt|beantragt))"
)
#: endings of surnames in Czech and Slovak and of some others
SURNAME = re.compile(r"(?i)(?:ov(?:á|é|ou|ej)|[sc]k(?:ý|á|é|ého|ému|ým|ém|ou|ej)|[bdhklnrtv](?:ý|á|é|ého|ému|ým)|mann|berger|sen|son|ovič|vić|enko)$")
ADDRESSED = {"pan", "pana", "panu", "pane", "panem", "paní", "slečna", "slečny", "slečně", "slečnu", "slečnou", "pán", "pána", "pánovi", "pani", "slečna", "herr", "herrn", "frau", "mr", "mrs", "ms", "miss", "p", "sl"}
STREET_BEFORE = re.compile(r"(?:\bul(?:ic[eiíou]+|icami|\.)?|\bul\.?|\btříd[aěuy]|\btř\.?|\bnáměstí|\bnám\.?|\bnábřeží|\bnábř\.?|\bškol[aeyuou]+|\bZŠ|\bMŠ|\bgymnázi\w+|\bsídliště|\bspolečnost\w*|\bfirm\w+|\bstraße|\bstrasse|\bstreet|\bschool|\bSchule)[  ]+$", re.I)
STREET_FIRST = {"Na", "Nad", "Pod", "Před", "Za", "U", "V", "Ve", "K", "Ke", "Mezi", "Pri", "Nám", "nám", "náměstí", "Náměstí", "třída", "tř", "Třída", "nábřeží", "Nábřeží"}
ADDRESS_HINT = re.compile(r"(?i)adres|bydli|bytem|sídl|wohnhaft|lives? at|residing|address|zasílejte|doruč|\bulic|\bul\.|nám|trval|dům|budov|anschrift|sitz|bydlisko|pobyt|provozovn|městský úřad|obecní úřad|nemovitost")
NOT_ADDRESS = re.compile(r"(?i)(?:parc|zákon|usnesení|usneseni|vyhlášk|přepáž|prepáž|kancelář|kancelária|dveře|smlouv|zmluv|zpráv|spis|účt|účet|IČO|částk|sbírk|článek|odst|bod|příloh|linka|room|counter|contract|schalter|telefon|tel|fax|mobil|číslo|volejte|OP|rok|roce|roku|strana|kapitola|den|dne|vydání|ročník|§|verze)\.?[  ]*(?:č\.?)?[  ]*$")

UP, LOW = "A-ZÁČĎÉĚÍĹĽŇÓÔŔŘŠŤÚŮÝŽÄÖÜ", "a-záčďéěíĺľňóôŕřšťúůýžäöüß"
S = "[  \t]"
_BLANKS = (" ", "\xa0", "\t")


def _forms(name: str) -> set[str]:
    """A given name's cases by the usual endings."""
    forms = {name}
    stems = {name}
    if name.endswith(("ek", "el", "ec", "en")) and name not in ("Daniel", "Samuel", "Gabriel", "Michael", "Emanuel"):
        stems.add(name[:-2] + name[-1])
    if name.endswith("ěk"):
        stems.add(name[:-2] + "k")
    if name.endswith("a"):
        stem = name[:-1]
        soft = {"k": "c", "r": "ř", "h": "z", "g": "z"}.get(stem[-1])
        forms |= {stem + e for e in ("y", "ě", "e", "u", "ou", "o", "i")} | ({stem[:-1] + soft + "e"} if soft else set())
    elif name.endswith(("ie", "e")):
        forms |= {name[:-1] + e for e in ("e", "i", "í")}
    elif name.endswith("í"):
        forms |= {name + e for e in ("ho", "mu", "m")}
    elif name.endswith("o"):
        forms |= {name[:-1] + e for e in ("a", "ovi", "em")}
    else:
        forms |= {s + e for s in stems for e in ("a", "e", "u", "ovi", "em", "om")}
    return forms


_GIVEN = {f for n in GIVEN.split() for f in _forms(n)}
_GIVEN_ANY = _GIVEN | {g.upper() for g in _GIVEN}

_AT = rf"(?:@|{S}?[\[({{<]{S}?(?:at|AT|zavináč|zavinac|ZAVINÁČ|@){S}?[\])}}>]{S}?|{S}(?:zavináč|zavinac|ZAVINÁČ|AT){S})"
_DOT = rf"(?:\.|{S}?[\[({{]{S}?(?:dot|DOT|tečka|tecka|bod|punkt|\.){S}?[\])}}]{S}?|{S}(?:tečka|tecka|dot|DOT|TEČKA){S})"
#: a sign with blanks around it counts where a dotted name follows, which prices ("41 ks @ 356 Kč") don't have
_APART = rf"(?:{S}@{S}|@{S})(?=[A-Za-z0-9\-]+(?:{_DOT}[A-Za-z0-9\-]+)*{_DOT}[A-Za-z]{{2}})"
_EMAIL = re.compile(rf"(?<![\w.+\-])[A-Za-z0-9](?:[A-Za-z0-9._+\-]|%)*(?:{_AT}|{_APART})[A-Za-z0-9](?:[A-Za-z0-9\-]*)(?:{_DOT}[A-Za-z0-9][A-Za-z0-9\-]*)+")
_DISGUISES = ("(at", "[at", "{at", "<at", "( at", "[ at", "(AT", "[AT", "[@", "(@", "zavin", "ZAVIN", " AT ")
#: runs of digits with the separators that numbers of people have
_NUMBER = re.compile(rf"(?<![\w/.\-+])(?:\(?(?:\+|00)(?:420|421|49|43|48|44|36|1){S}?\)?{S}?)?\(?\d(?:\)?(?:{S}?/{S}?|[.\-]|{S})?\d){{7,11}}(?![\w]|[/\-]\d|[.,]\d)")
#: runs of at least so many digits are looked at for card numbers
CARD_DIGITS = range(13, 20)
_IBAN = re.compile(rf"(?<![\w])[A-Z]{{2}}\d\d(?:{S}?[A-Z0-9]{{4}}){{2,7}}(?:{S}?[A-Z0-9]{{1,3}})?(?![\w])")
_ACCOUNT = re.compile(r"[A-Z]{2}\d{2}[A-Z0-9]{10,30}")
_LONG_RUN = re.compile(rf"(?<![\w])\d(?:(?:[.\-/]|{S})?\d){{12,}}(?![\w])")
_BARE = re.compile(r"[\s|;:,\-–*•]*")
_DATE = re.compile(r"\d{1,2}\.\s?\d{1,2}\.\s?\d{4}|\d{4}-\d\d-\d\d")
_MONEY = re.compile(r"[  ]?(?:Kč|EUR|CZK|ks\b|korun)")
_BIRTH = re.compile(rf"^\d{{6}}(?:{S}?/{S}?|{S})?\d{{3,4}}$")
_PHONE_HINT = re.compile(r"(?i)tel|mobil|fax|volejte|volat|zavolejte|telefon|na čísle|čísle|hlaste|linka|call|phone|ruf|kontakt|SMS|tel\.")
_CARD_HINT = re.compile(r"(?i)(?:\bOP\b|občansk\w+ průkaz\w*|č\. ?OP|číslo dokladu|cestovní\w* pas\w*|pasu|identity card|ausweis|občiansk\w+ preukaz\w*|doklad\w* (?:totožnosti)?)[^\n]{0,24}$")
_BIRTH_HINT = re.compile(r"(?i)r\. ?č|rodn|RČ|nar\.|birth|geburt")
_OTHER_NUMBER = re.compile(rf"(?i)(?:účet|účtu|účtem|konto|IBAN|IČO?|IČ|DIČ|zpráv\w*|spis\w*|značk\w*|SZ|č\.{S}?j|parc|smlouv\w*|contract|faktur\w*|variabilní|VS|souřadnic\w*|ID|datov\w+ schránk\w*|no|objednávk\w*)\.?{S}*(?:č\.?|číslo|no\.?)?{S}*:?{S}*$")
_SHORT = rf"(?:[{UP}]|nám|Nám|tř|nábř|sv|Sv|gen|Gen|kpt|Kpt|dr|Dr|arm|mjr|plk|prof|Prof)\."
_ADDRESS = re.compile(rf"(?<![\w.])((?:(?:{_SHORT}|náměstí|třída|nábřeží|[{UP}][{LOW}]*){S}?(?<=[ \.])){{0,4}}?(?:[{UP}][{LOW}]+|(?<= )(?:třída|ulice|náměstí|nábřeží)){S})((?:č(?:\.{S}?p\.|p\.|\.|íslo){S}?)?\d{{1,4}}[a-z]?(?:/\d{{1,4}}[a-z]?)?)(?![\w]|[.,:]\d|-\d|{S}?(?:%|Kč|EUR|ks|let|dní|dnů|hod|míst|m\b|km|metr|ročně|osob|million|crowns|Kronen)|{S}\d{{3}}\b)")
_POSTCODE = re.compile(rf"^,{S}*\d{{3}}{S}?\d{{2}}{S}+[{UP}]")
_CAPITAL = re.compile(rf"[{UP}][{UP}{LOW}]*(?:-[{UP}][{UP}{LOW}]+)?")
_TITLED = re.compile(rf"(?<!\w){TITLE}{S}+$")
#: forms of address as in ADDRESSED; a set at the beginning lets most of a text be passed over
_ADDRESSED = re.compile(rf"[PpSsHhFfMm](?:an(?:a|u|e|em|í|i)?|án(?:a|ovi)?|leč(?:na|ny|ně|nu|nou)|errn?|rau|rs?|iss|s|l)?\.?{S}+(?=[{UP}])")
_SENTENCE_WORDS = {"Starosta", "Místostarosta", "Zapsal", "Referent", "Odbor", "Rada", "Obec", "Město", "Městský", "Úřad", "Ulice", "Tel", "Dne", "Na", "V", "Za", "Pod", "U", "Dotazy", "Kontakt", "Most", "Podle", "Kraj", "Datová", "Usnesení", "Spolek", "Společnost", "Svoz", "Pozemek", "Snímky", "Kapacita", "Náklady", "Jednání", "Kronika", "Uzavírka", "Dodavatel", "Do", "Setkání", "Spor", "Výstava", "Smlouva", "Poruchy", "Fax", "Mobil", "Bližší", "Volejte", "Trvale", "Bydliště", "Korespondenci", "Sídlo", "Dům", "Rodné", "Číslo", "Totožnost", "Žádost", "Prodávající"}


def _NAME_SIGN(c: str) -> bool:
    """Whether a character may stand in an address's name."""
    return c.isalnum() and c.isascii() or c in "._+-%"


def luhn(digits: str) -> bool:
    """Check digit of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    """Modulo 97 of an international account number."""
    t = re.sub(r"\s", "", text).upper()
    return bool(_ACCOUNT.fullmatch(t)) and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def birth_number(digits: str) -> bool:
    """A date, women's months plus 50 (or 20 and 70), and modulo 11 from 1954 on."""
    month, day = int(digits[2:4]), int(digits[4:6])
    month -= 70 if month > 70 else 50 if month > 50 else 20 if month > 20 else 0
    if not (1 <= month <= 12 and 1 <= day <= 31):
        return False
    if len(digits) == 9:
        return int(digits[:2]) < 54
    return int(digits) % 11 == 0 or (int(digits[:9]) % 11 == 10 and digits[9] == "0")


def _disguised(text: str) -> Iterator[int]:
    """Places right after a name where a sign written in words or brackets may begin."""
    for sign in _DISGUISES:
        at = text.find(sign)
        while at >= 0:
            start = at
            while start and (text[start - 1] in _BLANKS or text[start - 1] in "([{<"):
                start -= 1
            if start and text[start - 1].isalnum() and (start < at or sign[0] in "([{< "):
                yield start
            at = text.find(sign, at + 1)


def _emails(text: str) -> Iterator[tuple[int, int, float]]:
    signs, at = [], text.find("@")
    while at >= 0:
        left, right = text[max(0, at - 2) : at], text[at + 1 : at + 3]
        # a single blank may stand on either side
        left, right = left[:-1] if left[-1:] in _BLANKS else left, right[1:] if right[:1] in _BLANKS else right
        if left[-1:].isalnum() and right[:1].isalnum():
            signs.append(at)
        at = text.find("@", at + 1)
    if any(x in text for x in _DISGUISES):
        signs = sorted({*signs, *_disguised(text)})
    done = 0
    for sign in signs:
        if sign < done:
            continue
        # the name begins where the characters of a name end, to the left of the sign and its brackets or blanks
        low = sign
        while low > done and not _NAME_SIGN(text[low - 1]):
            low -= 1
        while low > done and _NAME_SIGN(text[low - 1]):
            low -= 1
        while low < sign and not text[low].isalnum():
            low += 1
        if m := _EMAIL.match(text, low):
            e = m.end()
            while text[e - 1] in ".-":
                e -= 1
            if sign < e:
                yield low, e, 1.0
                done = e


def _refuted(text: str) -> list[tuple[int, int]]:
    """Places of account numbers that modulo 97 proves, and of card numbers that Luhn proves."""
    # a last short group may be the next word
    out = [m.span() for m in _IBAN.finditer(text) if iban(m[0]) or iban(re.sub(rf"{S}\w{{1,3}}$", "", m[0]))]
    for m in _LONG_RUN.finditer(text):
        digits, groups = re.sub(r"\D", "", m[0]), [len(g) for g in re.split(r"\D", m[0])]
        # cards are written in fours, as four, six and five, or without gaps, and begin with 2 to 6
        if len(digits) in CARD_DIGITS and digits[0] in "23456" and (len(groups) == 1 or set(groups[:-1]) == {4} or groups[:2] == [4, 6]) and luhn(digits):
            out.append(m.span())
    return sorted(out)


def _numbers(text: str) -> Iterator[tuple[int, int, str, float]]:
    refuted = None
    for m in _NUMBER.finditer(text):
        s, e = m.span()
        raw = m[0]
        digits = re.sub(r"\D", "", raw)
        foreign = raw.lstrip("(").startswith(("+", "00"))
        if not foreign and not 8 <= len(digits) <= 10:
            continue
        if not foreign and _DATE.match(raw):
            continue
        birth = not foreign and len(digits) in (9, 10) and bool(_BIRTH.match(raw)) and birth_number(digits)
        if not birth and not foreign and not (len(digits) == 9 and digits[0] in "1234567") and len(digits) != 8:
            continue
        before, after = text[max(0, s - CONTEXT) : s], text[e : e + 12]
        line = before.rsplit("\n", 1)[-1]
        # numbers of companies, accounts, parcels, files and messages
        penalty = 2.0 if _OTHER_NUMBER.search(line[-28:]) or _MONEY.match(after) else 0.0
        if _CARD_HINT.search(line) and len(digits) in (8, 9) and not foreign:
            yield s, e, "id_number", 1.5
            continue
        if birth:
            hint = 0.5 if _BIRTH_HINT.search(before) else 0.0
            if "/" in raw or len(digits) == 10 or hint:
                yield s, e, "id_number", (1.0 if len(digits) == 10 or hint else 0.5) + hint - penalty
                continue
        national = re.sub(r"^(?:00)?42[01]", "", digits) if foreign else digits
        if foreign and len(national) > 9 and national != digits:
            # nine digits follow these prefixes; what comes after them is another number, unless it's one with them
            place = [k for k, c in enumerate(raw) if c.isdigit()][len(digits) - len(national) + 8]
            if raw[place + 1].isdigit():
                continue
            raw, e, national = raw[: place + 1], s + place + 1, national[:9]
        shape = bool(re.search(r"\d[^\d]\d", raw.lstrip("(+")))
        hint = 0.5 if _PHONE_HINT.search(line) else 0.0
        if foreign and 7 <= len(national) <= 12 or len(national) == 9 and national[0] in "234567":
            # the account and card numbers of a text are looked for once it has a phone
            refuted = _refuted(text) if refuted is None else refuted
            if any(a < e and s < b for a, b in refuted):
                continue
            alone = bool(_BARE.fullmatch(line)) or line.rstrip().endswith((";", "|", ":", ","))
            yield s, e, "phone", (1.0 if foreign else 0.8 if shape else 0.5) + hint + (0.6 if alone else 0.0) - penalty


def _addresses(text: str) -> Iterator[tuple[int, int, float]]:
    for m in _ADDRESS.finditer(text):
        s, e = m.span()
        first = m[1]
        before, after = text[max(0, s - CONTEXT) : s].rsplit("\n", 1)[-1], text[e : e + 24]
        numbered = m[2].startswith("č")
        words = re.findall(rf"[{UP}{LOW}]+\.?", first)
        # words of the sentence before a street don't belong to it
        while len(words) > 1 and (words[0].rstrip(".") in _SENTENCE_WORDS - STREET_FIRST or words[0].lower() in ("ul.", "ulice", "ul")):
            at = text.index(words[0], s) + len(words[0])
            at += len(text[at:e]) - len(text[at:e].lstrip("  \t"))
            before, s = text[max(0, at - CONTEXT) : at].rsplit("\n", 1)[-1], at
            words = words[1:]
        if not words or NOT_ADDRESS.search(before) or words[-1].rstrip(".") in {"Usnesení", "Zákon", "OP", "IČO", "SZ", "Tel"} or (words[-1].rstrip(".") in _SENTENCE_WORDS and len(words) == 1):
            continue
        score = 0.4
        if ADDRESS_HINT.search(before):
            score += 0.6
        if _POSTCODE.match(after):
            score += 0.7
        if re.match(r"(?:nám|Nám|tř|nábř)", first) or re.search(rf"\bul(?:ice|ici|\.)?{S}+$", before):
            score += 0.6
        if words[0] in STREET_FIRST and len(words) > 1:
            score += 0.3
        if re.search(r"(?:sk[áéýo]|ck[áé]|ní|ov[aáé]|ová|ů)$", words[-1]):
            score += 0.3
        if numbered:
            score += 0.1
        yield s, e, score


def _is_gap(between: str) -> bool:
    return between in _BLANKS or between != "" and not between.strip(" \xa0\t")


def _persons(text: str) -> Iterator[tuple[int, int, float]]:
    caps = [(m.start(), m.end(), m[0]) for m in _CAPITAL.finditer(text) if m.start() == 0 or not (text[m.start() - 1].isalnum() or text[m.start() - 1] in "@_-/.")]
    n = len(caps)
    addressed = {m.end() for m in _ADDRESSED.finditer(text) if not m.start() or not text[m.start() - 1].isalnum() and text[m.start() - 1] != "_"}

    def titled(i: int) -> bool:
        s = caps[i][0]
        return s > 1 and text[s - 1] in _BLANKS and bool(_TITLED.search(text[max(0, s - 24) : s]))

    def joined(i: int) -> bool:
        return i + 1 < n and _is_gap(text[caps[i][1] : caps[i + 1][0]])

    def surname(i: int) -> bool:
        w = caps[i][2]
        return len(w) > 2 and w not in _SENTENCE_WORDS

    def unlisted(i: int) -> int | None:
        """The last word of a name whose given name isn't listed, if what stands around it and its shape say so."""
        if caps[i][2].lower() in ADDRESSED or not joined(i) or not surname(i) or not surname(i + 1) or i and joined(i - 1) and surname(i - 1):
            return None
        last = i + 1
        if joined(last) and surname(last + 1) and SURNAME.search(caps[last + 1][2]):
            last += 1
        if caps[i][2].isupper() != caps[last][2].isupper() and not caps[i][2].isupper():
            return None
        s, e = caps[i][0], caps[last][1]
        before, after = text[max(0, s - CONTEXT) : s].rsplit("\n", 1)[-1], text[e : e + 24]
        if STREET_BEFORE.search(before) or re.match(rf"^{S}?(?:č\.|čp\.|\d{{1,4}}(?!\d)|s\. ?r\. ?o|a\. ?s\.|spol\.|v\. ?o\. ?s|GmbH|Ltd)", after):
            return None
        alone = bool(re.fullmatch(r"[\s|*•#\-–]*", before)) and bool(re.match(r"\s*(?:\*\*)?(?:\n|\||$)", after))
        left = 0.7 if PERSON_WORD.search(before) else 0.5 if BEFORE_NAME.search(before) else 0.0
        right = 0.7 if BORN.match(after) else 0.5 if AFTER_NAME.match(after) else 0.0
        if joined(last) and max(left, right) < 0.7:
            return None
        score = 0.3 + left + right + 0.3 * bool(SURNAME.search(caps[last][2])) + 0.3 * alone
        return last if score >= ACCEPTED else None

    i = 0
    while i < n:
        s, e, w = caps[i]
        reversed_name = i + 1 < n and caps[i + 1][2] in _GIVEN
        pair = joined(i)
        if not (w in _GIVEN_ANY or len(w) == 1 or reversed_name or s in addressed or pair and titled(i)):
            if pair and (last := unlisted(i)) is not None:
                yield s, caps[last][1], 1.0
                i = last
            i += 1
            continue
        before = text[max(0, s - CONTEXT) : s]
        previous = re.search(rf"([^\W\d_]+)\.?{S}+$", before)
        word = previous[1].lower() if previous else ""
        end = None
        if w in _GIVEN_ANY and len(w) > 1:
            j = i
            while joined(j) and caps[j + 1][2] in _GIVEN_ANY and joined(j + 1) and surname(j + 2):
                j += 1
            if joined(j) and surname(j + 1):
                j += 1
                # two surnames
                if joined(j) and re.search(r"(?:ová|ové|ovou|ská|ské|skou|cká|cké|ckou)$", caps[j + 1][2]) and surname(j + 1):
                    j += 1
                end, last = caps[j][1], j
            elif j + 2 < n and len(caps[j + 1][2]) == 1 and re.match(rf"^{S}+$", text[caps[j][1] : caps[j + 1][0]]) and re.match(rf"^\.{S}+$", text[caps[j + 1][1] : caps[j + 2][0]]) and surname(j + 2):
                end, last = caps[j + 2][1], j + 2
        elif len(w) > 2 and reversed_name and joined(i) and (w.isupper() or re.search(r"ová|ský|ská|cký|cká", w)) and surname(i) and not (joined(i + 1) and surname(i + 2) and not w.isupper()):
            # surname first, as lists have it
            end, last = caps[i + 1][1], i + 1
        elif len(w) == 1 and i + 1 < n and re.match(rf"^\.{S}?$", text[e : caps[i + 1][0]]) and len(caps[i + 1][2]) > 2 and surname(i + 1) and (not word or word not in {"bod", "bodu", "vchod", "třída", "třídy", "skupina", "budova", "část", "hala", "sektor", "písm"}):
            # an initial; a sentence that ends with a single letter looks the same, so the word before must not speak against it
            starts = not previous and not re.search(r"[:,|;)\-–(„\"•][  ]*$", before)
            if not starts or text[caps[i + 1][1] : caps[i + 1][1] + 1] in "\n,;|" or re.match(r"^[  ]+[|;]", text[caps[i + 1][1] : caps[i + 1][1] + 4]):
                end, last = caps[i + 1][1], i + 1
        elif s in addressed and surname(i) and len(w) > 2:
            end, last = e, i
            if joined(i) and surname(i + 1) and word not in ("p", "sl"):
                end, last = caps[i + 1][1], i + 1
        elif len(w) > 2 and joined(i) and surname(i) and surname(i + 1) and titled(i):
            end, last = caps[i + 1][1], i + 1
        if end is None:
            i += 1
            continue
        score = 1.0
        after = text[end : end + 12]
        if STREET_BEFORE.search(before) and word not in ADDRESSED:
            score -= 1.0
        if re.match(rf"^{S}(?:č\.|čp\.|č\. ?p\.|\d)", after) and not re.match(rf"^{S}\d{{3}}[  ]?\d{{3}}", after):
            score -= 1.0
        if re.match(rf"^{S}?(?:s\. ?r\. ?o|a\. ?s\.|spol\.|v\. ?o\. ?s)", after):
            score -= 1.0
        yield s, end, score
        i = last + 1


def spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, type)`` of the accepted spans, none overlapping, in order."""
    found: list[tuple[int, int, int, str]] = []
    for s, e, score in _emails(text):
        if score >= ACCEPTED:
            found.append((ORDER.index("email"), s, e, "email"))
    for s, e, kind, score in _numbers(text):
        if score >= ACCEPTED:
            found.append((ORDER.index(kind), s, e, kind))
    for s, e, score in _addresses(text):
        if score >= ACCEPTED:
            found.append((ORDER.index("address"), s, e, "address"))
    for s, e, score in _persons(text):
        if score >= ACCEPTED:
            found.append((ORDER.index("person"), s, e, "person"))
    kept: list[tuple[int, int, str]] = []
    for _, s, e, kind in sorted(found):
        # spans kept so far are in order and apart, so only the neighbours can overlap
        i = bisect(kept, (s, e, kind))
        if (i == 0 or kept[i - 1][1] <= s) and (i == len(kept) or e <= kept[i][0]):
            kept.insert(i, (s, e, kind))
    return kept


def find(documents: DataFrame) -> DataFrame:
    """Distinct ``doc_id, pii_type, pii_text``; a NULL or empty text has none, equal rows give equal ones.

    Whole texts of any length are read; further columns are ignored; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, texts = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, piece in {(kind, text[s:e]) for s, e, kind in spans(text)}:
                    ids.append(doc)
                    kinds.append(kind)
                    texts.append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], ["doc_id", "pii_type", "pii_text"])

    source = spread(documents.where("text IS NOT NULL").select("doc_id", "text"))
    return source.mapInArrow(scan, "doc_id bigint, pii_type string, pii_text string").distinct()


def masked(documents: DataFrame) -> DataFrame:
    """``doc_id, text, n_pii``: every piece replaced by the placeholder of its type, the rest as it was."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts = [], []
            for text in batch.column(1).to_pylist():
                pieces, at = [], 0
                found = spans(text) if text else []
                for s, e, kind in found:
                    pieces += [text[at:s], PLACEHOLDERS[kind]]
                    at = e
                out.append(text if text is None else "".join(pieces) + text[at:])
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(counts, pa.int32())], ["doc_id", "text", "n_pii"])

    return spread(documents.select("doc_id", "text")).mapInArrow(scan, "doc_id bigint, text string, n_pii int")


def counts(documents: DataFrame) -> DataFrame:
    """``pii_type, n_docs, n_pieces`` over all documents."""
    return find(documents).groupBy("pii_type").agg(F.countDistinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_pieces"))
