"""The written forms of personal data: labels for training only, never used when data is found."""

from __future__ import annotations

import re

#: Given names that the labeller knows.
GIVEN = (
    "Abigail Alexander Alice Andrew Anna Antonio Barbara Benjamin Carlos Catherine Charles Christina Christopher Claire Daniel David Dolores Edward Elena Elizabeth Emma Ernst Eva Francisco François Frederick "
    "Friedrich George Gregory Hannah Hans Heinrich Helen Henrietta Henry Ingrid Isabel James Jean Johannes John Joseph Josephine Juan Julia Karl Katherine Laura Leila Louis Lucas Manuel Marcel Margaret Maria Marie "
    "Martin Michael Miguel Nicholas Odile Oliver Oswald Paul Pedro Peter Philippa Pierre Quentin Rebecca Renata Richard Robert Samuel Sarah Sophie Stephen Susan Thomas Ulrich Victoria Wilhelmina William Yusuf Zoltan"
).split()

_G = "(?:" + "|".join(sorted(set(GIVEN) | {g.upper() for g in GIVEN}, key=lambda x: (-len(x), x))) + ")"
_S = r"(?:[A-ZÀ-Þ][a-zß-ÿ]+(?:-[A-ZÀ-Þ][a-zß-ÿ]+)?|[A-ZÀ-Þ]{3,}(?:-[A-ZÀ-Þ]{3,})?)"
_W = r"(?: |[ ]?\n)"
_M = rf"(?:{_W}[A-Z]\.)?"
_NOT = r"(?!(?:[ ]|\n)(?:Street|St\b|Lane|Road|Rd\b|Terrace|Row|Ave|Papers|Library|University|Institute|Archive|Academy|Society|Museum|Prize|Press|Principle|Theorem|School|College|Hall|Bridge|Bay)\b)"

EMAIL = re.compile(
    r"(?<![\w.+-])[a-z0-9][\w.+-]*@[a-z0-9-]+(?:\.[a-z0-9-]+)+"
    r"|(?<![\w.+-])[a-z0-9][\w.+-]*[ \n]?(?:\[at\]|\(at\)|(?-i:\bAT\b)|\bat\b(?= ?[\w-]+ dot\b))[ \n]?[a-z0-9-]+(?:(?:[ \n]?(?:\[dot\]|\(dot\)|\bdot\b)[ \n]?|\.)[a-z0-9-]+)+",
    re.A | re.I,
)
PHONE = re.compile(
    r"(?<![\w./+-])(?<!\d )(?:"
    r"(?:\+|00)\d{1,3}[ .\-/]?(?:\(0\)[ ]?)?(?:\(?\d{1,5}\)?[ .\-/]?){1,5}\d{2,}"  # international
    r"|\(\d{2,5}\)[ ]?\d{2,8}(?:[ .\-]\d{2,6}){0,3}"  # area code in brackets
    r"|(?:1[-. ])?\d{3}[-. ]\d{3}[-. ]\d{4}"  # ten digits in threes and four
    r"|0\d{1,4}[ /][\d]{3,8}(?:[ \-]\d{2,6}){0,2}"  # area code
    r"|0\d(?:[ .]\d{2}){4}"  # pairs
    r"|1\d{2}[- ]?\d{4}[- ]?\d{4}"  # mobile of eleven digits
    r")(?:,? ?(?:ext\.?|x|转|Durchwahl|poste)[ ]?\d{1,5})?(?![\w])(?!\.\d)(?!-\d)",
    re.A,
)
_ID_CUE = re.compile(
    r"(?:passport|identity (?:card|number)(?: (?:number|no\.?))?|id(?:entity)? (?:no\.?|number)|tax (?:number|id|no\.?)|social security (?:number|no\.?)|national insurance (?:number|no\.?)|ssn|itin|nino"
    r"|ausweis(?:nummer|nr\.?)?|personalausweis(?:nummer)?|reisepass(?:nummer)?|pass(?:nummer|nr\.?)|steuer-?(?:id|nummer|nr\.?|identifikationsnummer)|sozialversicherungsnummer|idnr\.?"
    r"|pi[èe]ce d['’]identit[ée]|carte d['’]identit[ée]|num[ée]ro (?:de s[ée]curit[ée] sociale|fiscal)|passeport|n° fiscal|s[ée]curit[ée] sociale"
    r"|documento de identidad|n[úu]mero (?:fiscal|de la seguridad social|de identidad)|pasaporte|dni|nie|nif|seguridad social"
    r"|身份证(?:号码?)?|护照(?:号码?)?|税号|纳税人识别号|社保(?:号码?)?|证件号码?)"
    r"(?:[ \n]?(?:number|no\.?|n[°º]\.?|nr\.?|nummer|号码?|为|是|：|:|=|#|,))*[ \n]*",
    re.I,
)
_ID = re.compile(r"[A-Z0-9](?:[A-Z0-9]|[ .\-/\n](?=[A-Z0-9]{1,}(?:[ .\-/,;)\n]|$|[^A-Za-z])))*(?<=[A-Z0-9])", re.A)
_EN_STREET = r"(?:[A-Z][a-z]+(?: [A-Z][a-z]+)?|[A-Z]{3,}) (?:Street|St\.?|Lane|Ln\.?|Terrace|Ter\.?|Road|Rd\.?|Row|Avenue|Ave\.?|Square|Sq\.?|Close|Drive|Way|Court|Gardens|Hill)"
ADDRESS = re.compile(
    rf"(?<![\w])(?:(?:Flat|Apartment|Apt\.?|Unit|Suite) \d+[a-z]?,?{_W})?\d{{1,4}}[a-z]?,?{_W}{_EN_STREET.replace(' ', _W)}(?![a-z])(?:,?{_W}[A-Z][\w'-]+(?: (?:[A-Z]{{1,2}}\d{{1,2}} \d[A-Z]{{2}}|\d{{5}}|Bay))?)?"
    rf"|(?<![\w])(?:[A-ZÄÖÜ][a-zäöüß]+(?:straße|str\.|strasse|gasse|weg|platz|allee|damm|ufer|ring|markt)|(?:Am|An der|Zum|Zur|Im|Auf dem|Unter den){_W}(?!Jahr)[A-ZÄÖÜ][a-zäöüß]+(?:{_W}[A-ZÄÖÜ][a-zäöüß]+)?){_W}\d{{1,4}}[a-z]?(?![\w])(?:(?:,| in){_W}(?:\d{{5}}{_W})?[A-ZÄÖÜ][\w-]+)?"
    rf"|(?<![\w])(?:(?:appt?\.?|appartement|bât\.?){_W}\w+,?{_W})?\d{{1,4}}(?:{_W}?(?:bis|ter|quater)\b)?,?{_W}(?:rue|avenue|av\.|quai|impasse|bd|boulevard|place|pl\.|chemin|allée|cours|route)\b{_W}[^,.;\n]{{2,30}}?(?=,|\.|;|\n|à | et |$)(?:,?{_W}(?:à )?(?:\d{{5}}{_W})?[A-ZÀ-Þ][\w-]+)?"
    rf"|(?<![\w])(?:Calle|C/|C\.|Avda\.|Avenida|Av\.|Plaza|Pza\.|Paseo|P\.º|Camino|Ronda){_W}(?:(?:de|del|de la|de los|de las){_W})?(?:los |las |la )?[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+(?:{_W}[A-ZÁÉÍÓÚÑ][\wáéíóúñ]+)?,?{_W}(?:(?:n[º°]\.?|núm\.){_W}?)?\d{{1,4}}[a-z]?(?![\d])(?:,{_W}\d{{1,2}}[º°]\.?(?:{_W}[A-Z])?)?(?:,{_W}(?:\d{{5}}{_W})?[A-ZÁÉÍÓÚÑ][\w-]+)?",
)
_ZH = "(?:(?![在往于至到])[一-鿿])"
#: A town follows a verb or a stop; without one the street's name begins after it.
ADDRESS_ZH = re.compile(rf"(?<=[在往于至到址：: ，。\n])(?:{_ZH}{{1,7}}?[镇港谷市县区村乡城])?{_ZH}{{1,5}}?(?:路|街|大道|巷|弄|胡同)\d{{1,4}}号(?:\d+单元)?(?:\d+(?:室|楼))?")
PERSON = re.compile(
    rf"(?<![\w@.])(?:{_G}{_M}{_W}{_S}(?![\w@:]){_NOT}|{_S},{_W}{_G}{_M}(?![\w@])(?! {_S}{_NOT})|(?<!\b[a-zäöü]\. )(?<![A-Z]\. )[A-Z]\.{_W}?{_S}(?![\w@.]){_NOT}|{_S},{_W}[A-Z]\.(?!{_W}?[A-Z0-9])|{_S}{_W}{_G}(?![\w@]))"
)
_ZH_GIVEN = "玛塔 伊沃 露西娅 艾琳 卡斯帕 西尔维 海伦娜 托比 欧文 奥斯卡 安娜 玛丽 约翰 彼得 保罗 汉斯 卡尔 露易丝 索菲 尼古拉 托马斯 马丁 大卫 丹尼尔 爱德华 亚历山大 本杰明 凯瑟琳 伊丽莎白 威廉 罗伯特 弗里德里希".split()
PERSON_ZH = re.compile(rf"(?:{'|'.join(_ZH_GIVEN)})[·・•‧][一-鿿]{{1,5}}?(?=住在|借出|，|。|、|；|：|,|的|和|与|\n|$|（|\(|不|认|说|写|对|为|在|电)")

_AVOID = re.compile(r"(?:ISBN(?:-1[03])?:?|书号为?|ISSN|Order no\.|Shelf|Signatura|Signatur|Cote|索书号|vol\.|pp?\.|S\.|Band|Tomo|Tome|No\.|Nr\.|bestellnummer|commande|pedido|订单号)[ \n:为]*$", re.I)


def _free(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    return all(b <= x or a >= y for x, y in taken)


def label(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of personal data by its written form, in order, without overlaps."""
    out: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []

    def add(a: int, b: int, kind: str) -> None:
        if b > a and _free(taken, a, b):
            taken.append((a, b))
            out.append((a, b, kind))

    flat = text.replace("\n", " ")  # a line's end may fall anywhere within
    for m in EMAIL.finditer(flat):
        add(*m.span(), "email")
    for m in _ID_CUE.finditer(flat):
        if n := _ID.match(flat, m.end()):
            s = n.group()
            if sum(c.isdigit() for c in s) >= 4:
                add(*n.span(), "id_number")
    for rx in (ADDRESS, ADDRESS_ZH):
        for m in rx.finditer(flat if rx is ADDRESS else text):
            add(*m.span(), "address")
    for m in PHONE.finditer(flat):
        a, b = m.span()
        if not _AVOID.search(flat[max(0, a - 24) : a]) and 7 <= sum(c.isdigit() for c in m.group()) <= 16:
            add(a, b, "phone")
    for rx in (PERSON, PERSON_ZH):
        for m in rx.finditer(text):
            add(*m.span(), "person")
    return sorted(out)
