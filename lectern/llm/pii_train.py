"""Train the network of ``pii``: ``python -m lectern.llm.pii_train DOCUMENTS_PARQUET [OUT [HIDDEN]]``.

Its labelled spans are those of the written forms (``pii_rules``) in a bounded sample of windows, and the same windows
and made-up sentences with other names, numbers and addresses put in their place: names of many countries and scripts
that the forms know nothing of, so that the network has to tell them by shape and surroundings. Windows of other text,
and of names of places, institutions and works, are labelled as holding nothing. A tenth is held out. Then the windows
of the sample's texts that the network reads otherwise than they are labelled are added, with plain windows in other
letter case, and it is trained on.
"""

from __future__ import annotations

import random
import re
import sys

from lectern.llm import pii, pii_model
from lectern.llm.pii_rules import label

#: Windows that are trained on, at most.
SAMPLE = 36_000

Span = tuple[int, int, str]

#: Given names and surnames, beyond which names are made of syllables.
GIVEN = "Björn Xavier Søren Giulia Olga Mehmet Aoife Priya Kwame Yuki Mateo Lucía Nguyen Fatima Ahmed Ivana Pavel Agnieszka Lars Freja Giovanni Chiara Rui Inês Jürgen Günther Renée Zoé Thierry Gaëlle Íñigo Begoña Ramón Ximena Tariq Leila Omar Noor Siobhán Rhys Owain Tomasz Zuzanna Dmitri Svetlana Hiroshi Akiko Arjun Meera Chidi Amara Tendai Erik Astrid Jan Willem Bram Saskia Luc Amélie Benoît Carlo Paola Goran Mirela Stefan Ioana Eero Aino Kemal Aylin".split()
SURNAME = "Lindqvist Quill Sørensen Rossi Ivanova Yılmaz O'Brien Sharma Mensah Tanaka García Fernández Nguyen Haddad Kovács Novák Kowalska Johansson Nielsen Bianchi Silva Müller Schäfer Lefèvre Dubois Etxeberria Muñoz Rahman McCarthy Llewellyn Nowak Petrov Sokolova Suzuki Patel Okafor Moyo Berg van-Dijk Moreau Ricci Popescu Virtanen Demir Smith Walker Hall Weber Koch".split()
OTHER_SCRIPTS = "Иван Петров|Ольга Соколова|Дмитрий Волков|Мария Кузнецова|Николай Лебедев|Γιώργος Παπαδόπουλος|Ελένη Νικολάου|Анна Ковальчук".split("|")
HAN_SURNAME = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈"
HAN_GIVEN = "小明伟芳娜敏静丽强磊军洋勇艳杰娟涛超秀英霞平刚桂文辉玲建国志华红梅春燕宁浩宇轩雨欣思远子涵一鸣晓东海波佳怡"
HAN_SOUNDS = "玛塔伊沃露西娅艾琳卡斯帕尔维海伦娜托比欧文奥安丽约翰彼得保罗汉索菲尼古拉马大卫丹爱德华亚历山本杰明凯瑟琳威廉罗伯特兰诺雷诺米利克文萨"
SYLLABLES = "ta ro vi ske lun mar den fi gal bre tho nis kel or an zei dri po sta wen hul ba ri lo ma cho tur".split()
SENTENCES = {
    "en": [
        "The letter was signed by {person}.", "signed by {person}", "If found, please return it to {person}, {address}.", "{person} lives at {address} and can be reached on {phone}.", "Write to {email} or to {person}.",
        "Reviewed by {person} and {person} in 1998.", "According to {person}, the copy is complete.", "Passport number {id} was issued to {person}.", "My tax number is {id}.", "Dear {person}, thank you for the parcel.", "The reader {person} borrowed it twice.",
        "For questions, call {phone} or mail {email}.", "{person}: \"I have not seen the second volume.\"", "The {place} Library in {place} holds the papers of the {place} Society.", "{place} Bridge was rebuilt after the flood.", "The {place} Atlas and the {place} Chronicle agree.", "In {month} the {place} Archive closed its doors.",
        "Editors: {person}, {person}, {person}.", "This copy belongs to {person}", "contact: {email} / {phone}", "Order no. {num}-{num} was sent to the {place} Institute.", "Shelf mark {cap}{num}, ISBN 978-{num}-{num}-1.", "{person} wrote the preface to The {place} Voyage.", "By {person}", "{person} ({place}) disagrees.",
    ],
    "de": [
        "Unterschrieben von {person}.", "Das Exemplar gehört {person}, {address}.", "Bearbeitet von {person}, Tel. {phone}.", "Herr {person} wohnt in der {address}.", "Frau {person} schrieb an {email}.", "Ausweisnummer {id} liegt vor.", "Das Gutachten schrieb {person}.", "Die Bibliothek {place} liegt am Markt von {place}.", "Der Leser {person} gab den Band zurück.", "Nach {person} ist die Karte falsch.", "Rückfragen an {person}: {phone}",
    ],
    "fr": [
        "Signé par {person}.", "Cet exemplaire appartient à {person}, {address}.", "Madame {person} a écrit à {email}.", "Annoté par {person}, tél. {phone}.", "D'après {person}, la carte est fausse.", "Le numéro fiscal {id} figure au dos.", "La bibliothèque de {place} conserve le registre de {place}.", "Préface de {person}.", "Lu par {person} et {person}.",
    ],
    "es": [
        "Firmado por {person}.", "Este ejemplar pertenece a {person}, {address}.", "La señora {person} escribió a {email}.", "Llame a {person}, tel. {phone}.", "Según {person}, el mapa es falso.", "Número fiscal {id} anotado.", "La biblioteca de {place} guarda el registro de {place}.", "Prólogo de {person}.", "Leído por {person} y {person}.",
    ],
    "zh": [
        "信由{han}签署。", "信由 {han} 签署", "这本书属于{han}，电话：{phone}。", "作者{han}认为地图有误。", "请联系{han}，邮箱：{email}。", "批注人：{han}。", "借书人{han}住在{zaddress}。", "{han}老师写了序言。", "身份证号码{id}已登记。", "{hplace}图书馆保存着{hplace}的档案。", "据{han}说，副本已寄往{zaddress}。", "编者：{han}、{han}",
    ],
}
STREETS = {
    "en": ["{n} {w} Street, {t}", "{n}{l} {w} Lane, {t}", "Flat {m}, {n} {w} Road, {t}", "{n} {w} Avenue", "{n} {w} Terrace, {t} {cap}{cap}{m} {d}{cap}{cap}"],
    "de": ["{w}straße {n}, {z} {t}", "{w}weg {n}{l}, {z} {t}", "{w}platz {n}", "Am {w} {n} in {z} {t}", "{w}gasse {n}, {z} {t}"],
    "fr": ["{n}, rue des {w}, {z} {t}", "{n} bis, avenue de {w} à {t}", "{n}, quai du {w}, {t}", "appt {m}, {n} boulevard {w}, {t}"],
    "es": ["Calle de {w} {n}, {z} {t}", "Avda. {w} {n}, {m}.º B, {t}", "C/ {w}, n.º {n}, {z} {t}", "Plaza del {w} {n}"],
}
PHONES = ["+44 20 79## ####", "+49 30 #### ###", "0## ### ## ##", "(0##) #### ###", "###-###-####", "+33 1 ## ## ## ##", "00## ## ### ####", "+86 1## #### ####", "1##########", "0#.##.##.##.##", "+1 (###) ###-####", "0### / #######"]
IDS = ["##-###-####", "###-##-####", "@@ ## ## ## @", "@########", "########-@", "## ### ### ###", "#### #### ####", "##################", "@@#######", "#-##-##-##-###-###"]


class Maker:
    """Made-up names, numbers and addresses."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(2, 4))).capitalize()

    def digits(self, form: str) -> str:
        r = self.rng
        return "".join(str(r.randint(0, 9)) if c == "#" else r.choice("ABCDEFGHKLMNPRSTXYZ") if c == "@" else c for c in form)

    def given(self) -> str:
        return self.rng.choice(GIVEN) if self.rng.random() < 0.6 else self.word()

    def surname(self) -> str:
        r = self.rng
        s = r.choice(SURNAME) if r.random() < 0.5 else self.word()
        return s.replace("-", " ") if s.startswith("van") else f"{s}-{self.word()}" if r.random() < 0.08 else s

    def person(self) -> str:
        r = self.rng
        if r.random() < 0.06:
            return r.choice(OTHER_SCRIPTS)
        g, s = self.given(), self.surname()
        form = r.random()
        if form < 0.55:
            return f"{g} {s}"
        if form < 0.63:
            return f"{g} {r.choice('ABCDEFGHJKLMPRST')}. {s}"
        if form < 0.73:
            return f"{g[0]}. {s}"
        if form < 0.85:
            return f"{s}, {g}" if r.random() < 0.6 else f"{s}, {g[0]}."
        if form < 0.93:
            return f"{g} {s.upper()}" if r.random() < 0.5 else f"{s.upper()}, {g}"
        return f"{s} {g}" if form < 0.96 else f"{g} {s}".upper()

    def han(self) -> str:
        r = self.rng
        if r.random() < 0.5:
            return r.choice(HAN_SURNAME) + "".join(r.choice(HAN_GIVEN) for _ in range(r.randint(1, 2)))
        part = lambda a, b: "".join(r.choice(HAN_SOUNDS) for _ in range(r.randint(a, b)))
        return part(2, 4) + "·" + part(2, 4)

    def email(self) -> str:
        r = self.rng
        name = r.choice([f"{self.word()}.{self.word()}", f"{self.word()}{r.randint(1, 9999)}", f"{self.word()}_{r.randint(1, 99)}"]).lower()
        host, top = self.word().lower(), r.choice(["org", "com", "example", "test", "net", "de", "fr", "invalid", "example.org"])
        return r.choice([f"{name}@{host}.{top}"] * 3 + [f"{name} (at) {host} (dot) {top}", f"{name} [at] {host}.{top}", f"{name} AT {host} DOT {top}", f"{name} at {host} dot {top}"])

    def address(self, lang: str) -> str:
        r = self.rng
        form = r.choice(STREETS.get(lang, STREETS["en"]))
        return form.format(n=r.randint(1, 299), m=r.randint(1, 19), d=r.randint(1, 9), l=r.choice(["", "", "a", "b", "c"]), z=f"{r.randint(0, 99999):05d}", w=self.word(), t=self.word(), cap=r.choice("ABCDEGHKLMNRSTYZ"))

    def zaddress(self) -> str:
        r = self.rng
        part = lambda a, b: "".join(r.choice(HAN_SOUNDS) for _ in range(r.randint(a, b)))
        return r.choice([part(2, 4) + r.choice("镇港谷市县"), ""]) + part(2, 3) + r.choice("路街巷") + f"{r.randint(1, 400)}号" + r.choice(["", f"{r.randint(1, 30)}室"])

    def sentence(self, lang: str) -> tuple[str, list[Span]]:
        r = self.rng
        out, spans = "", []
        for piece in re.split(r"(\{\w+\})", r.choice(SENTENCES[lang])):
            if not piece.startswith("{"):
                out += piece
                continue
            slot = piece[1:-1]
            kind = {"person": "person", "han": "person", "address": "address", "zaddress": "address", "phone": "phone", "email": "email", "id": "id_number"}.get(slot)
            made = {
                "person": self.person, "han": self.han, "address": lambda: self.address(lang), "zaddress": self.zaddress, "phone": lambda: self.digits(r.choice(PHONES)), "email": self.email, "id": lambda: self.digits(r.choice(IDS)),
                "place": self.word, "hplace": lambda: "".join(r.choice(HAN_SOUNDS) for _ in range(3)) + r.choice("镇港谷山"), "month": lambda: r.choice("January March May August October".split()), "num": lambda: str(r.randint(10, 9999)), "cap": lambda: r.choice("ABCDQRZ"),
            }[slot]()
            if kind:
                spans.append((len(out), len(out) + len(made), kind))
            out += made
        return out, spans

    def other(self, s: str, kind: str) -> str:
        """Another value in the form of this one."""
        r = self.rng
        if kind in ("phone", "id_number"):
            return re.sub(r"\d", lambda m: str(r.randint(0, 9)), s)
        if kind == "email":
            return re.sub(r"[a-z]{4,}", lambda m: self.word().lower() if r.random() < 0.6 else m.group(), s)
        if kind == "address":
            return re.sub(r"\d", lambda m: str(r.randint(1, 9)), s)
        if "一" <= s[0] <= "鿿":
            return self.han()
        if re.search(r"\b[A-Z]\.", s) or "\n" in s:
            return re.sub(r"[A-ZÀ-Þ][a-zß-ÿ]{2,}(?=\W|$)", lambda m: self.surname() if r.random() < 0.7 else m.group(), s)
        if "," in s:
            a, b = s.split(",", 1)
            return f"{self.surname().upper() if a.isupper() else self.surname()},{b[: len(b) - len(b.lstrip())]}{self.given()}"
        return self.person()


def rewritten(maker: Maker, text: str, spans: list[Span]) -> tuple[str, list[Span]]:
    """A window with other values in the place of its own."""
    out, new, at = "", [], 0
    for a, b, kind in spans:
        if a < at or b > len(text):
            continue
        out += text[at:a]
        value = maker.other(text[a:b], kind)
        new.append((len(out), len(out) + len(value), kind))
        out, at = out + value, b
    if spans and spans[0][0] < 0:
        return text, spans
    rest = [s for s in spans if s[0] >= at and s[1] > len(text)]
    shift = len(out) - at
    return out + text[at:], new + [(a + shift, b + shift, k) for a, b, k in rest]


def sample(texts: list[str], seed: int = 5, most: int = SAMPLE) -> tuple[list[str], list[list[Span]]]:
    """Labelled windows: a third as they are, a third with other values, the rest made-up sentences and plain text."""
    rng = random.Random(seed)
    maker = Maker(rng)
    rows: list[tuple[str, list[Span]]] = []

    def cut(text: str, spans: list[Span], a: int, b: int) -> tuple[str, list[Span]]:
        return text[a:b], [(x - a, y - a, k) for x, y, k in spans if x < b and y > a]

    texts = texts.copy()
    rng.shuffle(texts)
    for t in texts:
        spans = label(t)
        done = -1
        for x, y, _ in spans:
            if x < done:
                continue
            a = max(0, x - rng.randint(10, 150))
            b = done = min(len(t), y + rng.randint(10, 120))
            row = cut(t, spans, a, b)
            rows += [row, rewritten(maker, *row)]
        for _ in range(1 + len(t) // 4000):
            a = rng.randrange(max(1, len(t) - 200))
            rows.append(cut(t, spans, a, a + 220))
        lang = "zh" if sum("一" <= c <= "鿿" for c in t[:200]) > 40 else rng.choice(["en", "en", "de", "fr", "es"])
        made, where = maker.sentence(lang)
        a = rng.randrange(max(1, len(t) - 60))
        before = cut(t, spans, max(0, a - rng.choice([0, 40, 90])), a)
        if not any(y > len(before[0]) for _, y, _ in before[1]):
            glue = rng.choice([" ", "\n", "\n\n", ". "])
            after, more = maker.sentence(lang) if rng.random() < 0.5 else ("", [])
            n = len(before[0]) + len(glue)
            text = before[0] + glue + made + " " + after
            rows.append((text, before[1] + [(x + n, y + n, k) for x, y, k in where] + [(x + n + len(made) + 1, y + n + len(made) + 1, k) for x, y, k in more]))
        if len(rows) > 2 * most:
            break
    rng.shuffle(rows)
    rows = [r for r in rows if r[0]][:most]
    return [t for t, _ in rows], [s for _, s in rows]


def score(finder: pii.Finder, windows: list[str], spans: list[list[Span]]) -> dict[str, tuple[float, float, int]]:
    """(precision, recall, number) of starts by kind."""
    said, there, good = ({k: 0 for k in pii_model.KINDS} for _ in range(3))
    for got, want in zip(finder.decode(windows), spans):
        want_ = {(a, k) for a, _, k in want if a >= 0}
        got_ = {(a, k) for a, _, k in got if a > 0 or (a, k) in want_}
        for n, s in ((said, got_), (there, want_), (good, got_ & want_)):
            for _, k in s:
                n[k] += 1
    return {k: (round(good[k] / max(said[k], 1), 4), round(good[k] / max(there[k], 1), 4), there[k]) for k in there}


def harder(texts: list[str], finder: pii.Finder, seed: int = 6) -> tuple[list[str], list[list[Span]]]:
    """Windows around the spans that the finder misses or makes up, thrice each, and plain text with all words in capitals."""
    rng = random.Random(seed)
    rows: list[tuple[str, list[Span]]] = []
    for at in range(0, len(texts), 1000):
        part = texts[at : at + 1000]
        for t, got in zip(part, finder.find(part)):
            want = label(t)
            for a, b, _ in set(got) ^ set(want):
                for _ in range(3):
                    x, y = max(0, a - rng.randint(20, 140)), min(len(t), b + rng.randint(20, 140))
                    rows.append((t[x:y], [(p - x, q - x, k) for p, q, k in want if p < y and q > x]))
            a = rng.randrange(max(1, len(t) - 220))
            if rng.random() < 0.3 and not any(p < a + 220 and q > a for p, q, _ in want):
                change = rng.choice([str.title, str.title, str.upper])
                plain = change(t[a : a + 220])
                rows.append((plain, []))
    return [t for t, _ in rows if t], [s for t, s in rows if t]


def main(path: str, out: str = pii.WEIGHTS, hidden: str = str(pii_model.HIDDEN), epochs: str = "18", start: str | None = None) -> None:
    """``start`` names weights that the first training ended with; where they are those of the last, the gate alone is trained."""
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(path, columns=["text"]).column(0).to_pylist() if t]
    windows, spans = sample(texts)
    cut = len(windows) // 10
    print(len(windows), "windows", sum(map(len, windows)), "characters of", sum(map(len, texts)), flush=True)

    def say(epoch: int, loss: float, vocabulary, w) -> None:
        print(epoch, round(loss, 5), flush=True)

    def report() -> None:
        print("held out: precision, recall, number", score(pii.Finder(*pii_model.load(out)), windows[:cut], spans[:cut]), flush=True)

    if not start:
        pii_model.save(out, *pii_model.train(windows[cut:], spans[cut:], hidden=int(hidden), epochs=int(epochs), say=say))
        report()
    model = pii_model.load(start or out)[:2]
    held = set(windows[:cut])
    more, more_spans = harder(texts, pii.Finder(*model))
    more, more_spans = zip(*((t, s) for t, s in zip(more, more_spans) if t not in held))
    print(len(more), "harder windows", flush=True)
    if epochs != "0":
        model = pii_model.train(windows[cut:] + list(more), spans[cut:] + list(more_spans), epochs=int(epochs) // 2, rate=2e-3, say=say, start=model)
    gate = train_gate(model[0], windows[cut:] + list(more), spans[cut:] + list(more_spans), say)
    pii_model.save(out, *model, gate)
    report()


def train_gate(vocabulary: pii_model.Vocabulary, windows: list[str], spans: list[list[Span]], say, epochs: int = 14) -> dict:
    start = (vocabulary, pii_model.initial_gate(len(vocabulary)))
    return pii_model.train(windows, spans, epochs=epochs, batch=128, rate=1e-2, say=say, start=start, gate=True)[1]


if __name__ == "__main__":
    main(*sys.argv[1:])
