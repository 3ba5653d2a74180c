"""Defective prompt and response pairs (problem 1), found by ordered rules.

Each pair goes once through an Arrow-batched function, which folds its texts once and tries the rules in their
order: emptiness, copied prefixes, refusals, language and script mismatch, unclosed delimiters and abrupt ends.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

# The most frequent words of five languages; what they share with each other speaks for all of them.
WORDS = {
    "cs": "a aby ale ani asi až bez bude budou byl byla bylo byly být co či do ho i já jak jako je jeho její jejich jen ještě jsem jsi jsme jsou jste k kde kdo kdy když která které který kterou kterého ke kolik lze má mají mám máte mezi mi může mohu mohl možné musí musím můžete my na nad nám nás nebo než ne není ní o od on ona oni pak po pod podle pokud pouze pro proč proto před předem při s se si své svůj ta tady tak také tam té ten této tím to tohoto toto tu tuto ty u už v vám vás váš ve vše však z za ze že dobrý den děkuji prosím chtěl bych dní trvá obvykle",
    "sk": "a aby ale ani asi až bez bol bola boli bolo bude budú budeme byť cez čo či do ho i ja ak ako je jeho jej ich len ešte som si sme sú ste k kde kto kedy keď ktorá ktoré ktorý ku koľko má majú mám máte medzi mi môže môžem môžete možno musí musím my na nad nám nás alebo než nie o od on ona oni potom po pod podľa pokiaľ iba pre prečo preto pred pri s sa si svoje tá tu tak tiež tam tej ten tejto tým to tohto toto túto ty u už v vám vás váš vo všetko však z za zo že dobrý deň ďakujem prosím chcel by dní trvá",
    "pl": "a aby ale ani bez być był była było były będzie co czy dla do go i ile ja jak jako je jego jej ją jest jestem jeśli już kiedy kto która które który którzy lub ma mają mam mi może można mogę mogą musi my na nad nam nas nie nich o od on ona oni oraz po pod podczas przed przez przy się są swoje ta tak także tam tego tej ten to tu ty tylko tym u w was we więc wszystko z za ze że żeby proszę należy dzień dobry dziękuję gdzie dlaczego",
    "de": "aber als am an auch auf aus bei bin bis das dass dem den der des die dies diese dieser doch du durch ein eine einem einen einer er es für haben hat ich ihm ihn ihr ihnen im in ist ja kann können man mehr mein mit muss nach nicht noch nur oder ohne schon sein sich sie sind so über um und uns unter vom von vor war was welche welchen wenn wer werden wie wir wird wo zu zum zur bitte guten tag danke",
    "en": "a about after all also an and any are as at be been before but by can could did do does for from had has have he her his how i if in into is it its just may me more must my no not of on only or our out over please she should so some such than that the their them then there these they this those to up us was we were what when where which who why will with would you your hello thank thanks need last month year week day get go new like make want help time use find one two first many much",
}
# Frequent words of further languages; those that a language above also has don't count.
FURTHER = {
    "fr": "le la les des du un une est sont pour dans avec vous nous je ne pas que qui sur votre vos cette ce ces aux par ou etre avoir peut pouvez sans plus tout mais comme demande mairie bonjour merci",
    "es": "el los las del una es son para con usted ustedes nosotros que no por su sus este esta estos como puede pueden sin mas pero donde cuando solicitud ayuntamiento gracias hola debe hay",
    "it": "il lo gli della delle dei un una e sono per con voi noi che non di al alla nel nella questo questa come puo potete senza piu ma dove quando domanda comune grazie deve presso",
    "pt": "os as da das dos um uma sao para com voce que nao por seu sua este esta como pode podem sem mais mas onde quando pedido obrigado deve no na ao pela",
    "nl": "het een zijn voor met u wij dat niet op aan bij uw deze dit hoe kan kunt zonder meer maar waar wanneer aanvraag gemeente dank moet worden ook naar",
    "hu": "az egy es nem hogy meg van vannak kell lehet ez ezt kerem koszonom onkormanyzat kerelem hol mikor mennyi vagy csak mar ha is hivatal ugyfel igen",
    "ro": "si nu este sunt pentru cu care din la mai sau cum poate puteti fara unde cand cerere primaria multumesc trebuie acest aceasta prin dumneavoastra",
    "hr": "i su za koji koja koje kako gdje kada moze mozete bez vise ali zahtjev opcina hvala treba ovo ova nije sto iz uz kod prema",
}
# Letters and letter groups by language, asked for where words don't tell.
GROUPS = {
    "cs": "ř ě ů ou ého ní", "sk": "ľ ĺ ŕ ô ä ého ie", "pl": "ł ę ą ś ż sz cz rz", "de": "ß ü sch ung ein ich", "en": "th ing wh ght tion ee", "fr": "ç ê eau oi ux é", "es": "ñ ción ll ¿ ad os",
    "it": "zione gli cch à ò tt", "pt": "ã õ ção lh nh", "nl": "ij oo aa een cht", "hu": "ő ű gy sz ny á", "ro": "ă ț ș ul ea", "hr": "đ ije nj lj ć",
}
# Letters that few of these languages have, looked for in words without a capital.
LETTERS = {"cs": set("řěů"), "sk": set("ľĺŕôä"), "pl": set("łżśćąęźń"), "de": set("ßüöä"), "hu": set("őűöü"), "hr": set("ćđ")}
# Code point ranges of other scripts, taken as languages of their own.
SCRIPTS = {"cyrillic": "\u0400-\u052f", "greek": "\u0370-\u03ff", "arabic": "\u0600-\u06ff", "hebrew": "\u0590-\u05ff", "han": "\u3040-\u30ff\u4e00-\u9fff", "hangul": "\uac00-\ud7af"}
# How a question asks for a language, folded.
REQUESTS = {
    "cs": r"\bcesk[yu]\b|\bcestin|\bin czech\b|\bauf tschechisch|\bpo czesku",
    "sk": r"\bslovensky\b|\bslovencin|\bin slovak\b|\bauf slowakisch|\bpo slowacku",
    "en": r"\banglicky\b|\banglictin|\bin english\b|\bauf englisch|\bpo angielsku",
    "de": r"\bnemecky\b|\bnemcin|\bin german\b|\bauf deutsch|\bpo niemiecku",
    "pl": r"\bpolsky\b|\bpolstin|\bin polish\b|\bauf polnisch|\bpo polsku",
}


ROLE = re.compile(r"(?i)^\s*(?:human|user|bot|assistant|uživatel|asistent|otázka|odpověď|question|answer|q|a)\s*:\s*")
# Stand-ins for "nothing", folded.
NOTHING = r"^(?:|null|none|nil|nan|n a|na|undefined|empty|void|tbd|todo|prazdn[ay] odpoved|prazdne|bez odpovedi|zadna odpoved|zadna|nic|neuvedeno|no answer|no response|leer|keine antwort|brak|brak odpowiedzi|ziadna odpoved|nevyplneno)$"
# Phrases before a repeated question, folded.
LEAD_IN = r"\b(?:ptate se(?: na(?: toto)?)?|vas dotaz|vase otazka|otazka|odpoved|dotaz zni|you asked|your question|question|answer|ihre frage|frage|antwort|pytanie|odpowiedz|pytate sa|vasa otazka)\b"
# Courtesies that say nothing by themselves, folded, one sentence each.
COURTESY = r"^(?:dobry den|ahoj|zdravim|hezky den|pekny den|prijemny den|na shledanou|dekuji(?: vam)?(?: za (?:dotaz|zpravu|otazku|trpelivost))?|dobry den dekuji za (?:dotaz|zpravu|otazku)|dakujem(?: za otazku)?|dzien dobry|guten tag|hello|hi|good day|have a nice day|thank you(?: for your question)?|danke(?: fur ihre frage)?|rozumim|chapu|i understand|mohu (?:vam )?(?:pomoci|poradit) s necim jinym|prejete si jeste neco|can i help (?:you )?with (?:anything|something) else|mohu jeste nejak pomoci|omlouvam se|prominte|lituji|sorry|i m sorry|je mi lito|bohuzel|s pozdravem)$"
# First persons that decline by themselves, folded.
DECLINING = set(
    "nevim netusim neporadim nepomohu nepomuzu nezodpovim neodpovim neodpovidam nereknu nesdelim nedisponuji nepodam nesmim neposlouzim "
    "neviem netusim neporadim nepomozem neodpoviem neodpovedam nepoviem nesmiem nedisponujem nie_wiem nie_odpowiem nie_pomoge nie_doradze nie_powiem".split()
)
# First persons that decline together with a word of asking, knowing or helping, folded.
UNABLE = set(
    "neznam nemam nemame neumim nedokazu nemohu nemuzu nemuzeme nejsem nejsme neposkytuji neposkytujeme nenasel nenasla nenalezl nenalezla nerozumim nelze neni nepatri neprislusi nepristusi zakazano "
    "nepoznam nemame neviem nedokazem nemozem nemozeme nie_som neposkytujem nenasiel nenasla nerozumiem nie_je nepatri neprislucha zakazane "
    "nie_znam nie_mam nie_moge nie_potrafie nie_umiem nie_jestem nie_posiadam nie_rozumiem nie_udzielam "
    "cannot can_not can_t could_not couldn_t unable not_able do_not don_t not_allowed no not nicht kein keine keinen ne_peux ne_sais ne_suis no_puedo no_se no_tengo non_posso non_so nem_tudok nem_tudom".split()
)
# Beginnings of the words that an assistant's knowing, answering and helping is about, folded.
ABOUT = tuple(
    "odpoved otazk otazc dotaz informac udaj podklad tema tematu temat zodpoved odpovid poradit poradenst pomoc pomoct pomoci znam komentovat sdelovat opravnen schopen kompeten rozsah silach moznostech vedet pozadavk reknu odpovedat odpovedet pravidl "
    "otazku informacie temu pomoct poradit povedat znalost odpowied odpowiedz pytan informacj pomoc temat wiedz upowaznion stanie "
    "help answer assist know information advise comment outside scope beyond question topic able tell provide discuss respond qualified "
    "beantwort helf weiterhelf auskunft information antwort frage weiss thema sagen beraten befugt "
    "reponse repondre aider question respuesta responder ayudar pregunta rispondere aiutare risposta domanda segiteni valaszol valaszt kerdes".split()
)
# Words that decline wherever a sentence has them, folded.
ALOOF = re.compile(r"\bmimo (?:rozsah|moje|me|mou|nase)|\bnad ramec\b|\bbeyond (?:my|the scope)|\boutside (?:of )?(?:what|my|the scope)|\bje mi to zakazano\b|\bk tomu(?:to tematu)? nemam\b|\b(?:ani )?nic (?:mi )?neni (?:o tom )?znamo\b|\bneni (?:mi )?(?:o tom )?nic znamo\b|\bkann ich .*\b(?:nicht|keine)\b|\bweis+ ich nicht\b")
# Negations that belong to the word after them.
_TWO = re.compile(r"\b(nie|can|could|couldn|do|don|not|ne|no|non|nem) (wiem|odpowiem|pomoge|doradze|powiem|som|je|znam|mam|moge|potrafie|umiem|jestem|posiadam|rozumiem|udzielam|not|t|able|allowed|peux|sais|suis|puedo|se|tengo|posso|so|tudok|tudom)\b")
# What may follow a refusal without answering anything, folded.
DEFERRAL = r"^(?:obratte se|obratte sa|zeptejte se|zkuste|kontaktujte|prosim (?:obratte|kontaktujte|zkuste)|please (?:contact|try|ask)|try |contact |bitte (?:wenden|kontaktieren|fragen)|wenden sie|prosze (?:skontaktowac|zwrocic)|skuste|jako virtualni asistent|as (?:a|an) (?:virtual|ai) )"
_COURTESY, _DEFERRAL, _NOTHING, _LEAD_IN = (re.compile(p) for p in (COURTESY, DEFERRAL, NOTHING, LEAD_IN))
_ASKED = {language: re.compile(p) for language, p in REQUESTS.items()}
_NEGATIVE = re.compile(r"\bne|\bno\b|\bnot\b|\bnon\b|\bnie\b|nicht|\bkein|cannot|can t|don t|unable|mimo|zakaz|nad ramec|outside|beyond|weis")

_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff]+")
_WORD = re.compile(r"[^\W_]+")
_MARKUP = re.compile(r"(?s)<!--.*?-->|<[^<>]*>|&nbsp;|&#160;")
_SENTENCE = re.compile(r"[\r\n]\s*|[.!?][\"“”')]?\s+")
_QUOTED = re.compile(r"„[^“”\"]*[“”\"]|\"[^\"\n]*\"|“[^”\n]*”|»[^«\n]*«|https?://\S+|\]\([^)]*\)")
_NOT_LATIN = re.compile("[\u0370-\u1dff\u2c60-\ud7ff]")
_SCRIPT = {name: re.compile(f"[{span}]") for name, span in SCRIPTS.items()}


#: Signs as blanks, and letters that have no decomposition.
_PLAIN = str.maketrans({c: " " for c in [*map(chr, range(0x80)), *"„“”‚‘’…–—•·»«§°\xa0"] if not c.isalnum()} | {"ł": "l", "đ": "d", "ß": "s", "ø": "o"})


def fold(text: str) -> str:
    """Lower-case words without diacritics, one blank between them, nothing else."""
    low = text.lower()
    if not low.isascii():
        low = _MARKS.sub("", unicodedata.normalize("NFKD", low))
    words = " ".join(low.translate(_PLAIN).split())
    # rarer signs are left to the slower way
    return words if not words or words.replace(" ", "").isalnum() else " ".join(_WORD.findall(low.translate(_PLAIN)))


_SPEAKERS: dict[str, list[str]] = {}
for _language, _words in WORDS.items():
    for _w in set(fold(_words).split()):
        _SPEAKERS.setdefault(_w, []).append(_language)
_SHARED = set(_SPEAKERS)
for _language, _words in FURTHER.items():
    for _w in set(fold(_words).split()) - _SHARED:
        _SPEAKERS.setdefault(_w, []).append(_language)


_SIGNS = ".,:;!?()[]{}<>\"'„“”‚‘’…–—-*_/|"


@lru_cache(65536)
def _speakers(token: str) -> list[str]:
    """The languages a word speaks for, twice those whose letters it has; signs around it don't matter."""
    word = token.strip(_SIGNS)
    if not word:
        return []
    # words without a capital only: place names keep their letters in every language
    own = [c for c, letters in LETTERS.items() if word[0].islower() and not letters.isdisjoint(word)]
    return [language for w in fold(word).split() for language in _SPEAKERS.get(w, ())] + own * 2


def _clear(hits: Counter, least: int, margin: float) -> str | None:
    ranked = hits.most_common(2)
    return ranked[0][0] if ranked and ranked[0][1] >= least and (len(ranked) == 1 or ranked[0][1] > margin * ranked[1][1]) else None


def guess_language(text: str | None) -> str | None:
    """A language code, a script's name, or None where neither words nor letter groups speak for one alone."""
    if not text:
        return None
    if not text.isascii() and _NOT_LATIN.search(text):
        letters = sum(map(str.isalpha, text))
        for name, script in _SCRIPT.items():
            if 2 * len(script.findall(text)) > letters > 0:
                return name
    words = text.split()
    found = _clear(Counter(chain.from_iterable(map(_speakers, words))), 2, 1.0)
    if found or len(words) < 4:
        return found
    plain = " ".join(w for w in words if w[0].islower())
    return _clear(Counter({c: n for c, groups in GROUPS.items() if (n := sum(plain.count(g) for g in groups.split()))}), 5, 1.5)


def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    if len(answer) > 200 and "<" not in answer:
        return not any(map(str.isalnum, answer))
    return bool(_NOTHING.match(fold(ROLE.sub("", _MARKUP.sub(" ", answer)))))


def is_copy(words: str, question: str) -> bool:
    """Nothing is left once lead-ins and the question, however often and however cut off at the end, are taken out."""
    if not question or not words:
        return False
    # a copy has the question, or begins with a lead-in or as the question does
    if question not in words and not _LEAD_IN.match(words) and not question.startswith(words[:8]):
        return False
    for bare in (f" {words} ", f" {_LEAD_IN.sub(' ', words)} "):
        rest = " ".join(bare.replace(f" {question} ", "  ").replace(f" {question} ", "  ").split())
        if rest == bare.strip():
            # not even once; the beginning of the question is a copy if it's half of it
            if rest and len(rest) * 2 >= len(question) and question.startswith(rest):
                return True
        elif not rest or question.startswith(rest) or not _LEAD_IN.sub(" ", rest).strip():
            return True
    return False


def declines(sentence: str) -> bool:
    """Whether a folded sentence says that the speaker can't or won't answer."""
    if not _NEGATIVE.search(sentence):
        return False
    if ALOOF.search(sentence):
        return True
    words = _TWO.sub(r"\1_\2", sentence).split()
    if not DECLINING.isdisjoint(words):
        return True
    return not UNABLE.isdisjoint(words) and any(w.startswith(ABOUT) for w in words)


def is_refusal(answer: str) -> bool:
    """At least one sentence declines and no other one says anything."""
    refused, at = False, 0
    # sentence by sentence: the first one that says something ends it
    while at < len(answer):
        m = _SENTENCE.search(answer, at)
        s = fold(answer[at : m.end()] if m else answer[at:])
        at = m.end() if m else len(answer)
        if not s:
            continue
        if declines(s):
            refused = True
        elif not _COURTESY.match(s) and not _DEFERRAL.match(s):
            return False
    return refused


# Abbreviations with a dot that want a word after them.
OPEN_ABBREVIATION = re.compile(r"(?i)(?:^|[\s(])(?:č|čís|např|tzv|tj|ul|nám|str|odst|písm|tel|resp|popř|příp|vč|zák|sb|mj|kap|čl|nr|no|e\.g|i\.e|bzw|np)\.$")
PHONE_OR_LINK = re.compile(r"(?i)(?:[\d)][\d\s  /.()-]{5,}\d|https?://\S+|www\.\S+|\S+@\S+\.\w+|\]\(\S+\))[)\]>*_\"“”']*$")
_STOP = re.compile(r"[.!?…][\"“”')\]*_\s]*$")
# emoji and other symbols end a line as well as a full stop
_SMILE = re.compile(r"[\u2190-\u2bff\ufe0f\U0001f000-\U0001faff]$|[:;]-?\)$")
_MARKER = re.compile(r"(?i)^(?:[-*•+]|\d+[.)])\s*$|^(?:[-*•+])?$|[,:;–—(\[-]$|(?:^|\s)(?:a|i|o|u|v|s|z|k|na|do|od|po|za|že|nebo|ale|který|která|které|kterou|je|jsou|the|and|or|of|to|und|oder|die|der|alebo|oraz|w)$")
_ITEM = re.compile(r"\n\s*(?:[-*•+]|\d+[.)])\s+[^\n]*$")
_TAG_CUT = re.compile(r"<(?:[a-zA-Z/][^<>]*)?$")
_BLANKS = " \t\r\n\f\v\xa0\u2002\u2003\u2009\u202f\u3000\u200b\ufeff"


def _left_open(text: str, opening: str, closing: str) -> bool:
    """Whether an opening bracket has no closing one anywhere after it."""
    return text.rfind(opening) > text.rfind(closing)


def is_truncated(answer: str) -> bool:
    text = answer.rstrip(_BLANKS)
    last = text.rsplit("\n", 1)[-1].strip()
    dangling = (
        _left_open(text, "(", ")") and not last.endswith((":(", ";("))
        or _left_open(text, "[", "]")
        or text.count("**") % 2 == 1
        or text.count("```") % 2 == 1
        or "„" in text and text.count("„") > sum(map(text.count, "“”\""))
        or "<" in text and bool(_TAG_CUT.search(text, text.rfind("<")))
    )
    if dangling:
        return True
    if _STOP.search(last) and not OPEN_ABBREVIATION.search(last[-16:]) or _SMILE.search(last[-3:]) or PHONE_OR_LINK.search(last):
        return False
    item = "\n" in text and bool(_ITEM.search(text, text.rfind("\n"))) or last.startswith("|") and last.endswith("|") and len(last) > 1
    alone = "\n" not in text and len(last.split()) <= 3
    return not ((item or alone) and not _MARKER.search(last))


RULES = ("empty", "copy", "refusal", "wrong_language", "truncated")


def triggered(question: str | None, answer: str | None, default_language: str = "cs") -> list[str]:
    """Every rule of ``RULES`` that a pair triggers, in their order."""
    out = []
    if is_empty(answer):
        out.append("empty")
    if answer is None:
        return out
    q, a = ROLE.sub("", question or "").strip(), ROLE.sub("", answer)
    asked, said = fold(q), fold(a)
    if is_copy(said, asked):
        out.append("copy")
    if is_refusal(a):
        out.append("refusal")
    if asked:
        spoken = guess_language(_QUOTED.sub(" ", a))
        if spoken and spoken != (guess_language(q) or default_language) and not (spoken in _ASKED and _ASKED[spoken].search(asked)):
            out.append("wrong_language")
    if is_truncated(a):
        out.append("truncated")
    return out


def judged(pairs: DataFrame, default_language: str = "cs") -> DataFrame:
    """``pair_id, defect_type, rank``: every rule a pair triggers, in the rules' order (rank from 1).

    A NULL or blank answer is ``empty``; a NULL question can be neither copied nor of another language.
    A question too short to tell its language has ``default_language``; an answer too short to tell never
    is ``wrong_language``. Equal rows give equal results, an empty table none; further columns are ignored.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, defects, ranks = [], [], []
            for pair, question, answer in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for defect in triggered(question, answer, default_language):
                    ids.append(pair)
                    defects.append(defect)
                    ranks.append(RULES.index(defect) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(defects, pa.string()), pa.array(ranks, pa.int32())], ["pair_id", "defect_type", "rank"])

    return spread(pairs.select("pair_id", "question", "answer")).mapInArrow(judge, "pair_id bigint, defect_type string, rank int")


def defects(pairs: DataFrame, default_language: str = "cs") -> DataFrame:
    """Distinct ``pair_id, defect_type``: the first rule in order that a pair triggers.

    A later rule's trigger on the same text is its consequence: an empty answer also breaks off, a copied
    question also ends without a full stop.
    """
    first = F.array_min(F.collect_set(F.struct("rank", "defect_type")))["defect_type"]
    return judged(pairs, default_language).groupBy("pair_id").agg(first.alias("defect_type"))


def all_defects(pairs: DataFrame, default_language: str = "cs") -> DataFrame:
    """Distinct ``pair_id, defect_type`` of every triggered rule."""
    return judged(pairs, default_language).select("pair_id", "defect_type").distinct()
