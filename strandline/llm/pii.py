"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes for what has no pattern.

Patterns give e-mail and IP addresses, card and phone numbers. The field adds names (beside words such as "name", "Dear" or "Sincerely"),
numbers of documents (id) and telephone numbers without a country code (tel). It is trained on LABELLED, a small table of marked sentences, by
gradient ascent on the conditional likelihood, and decoded by Viterbi over whole texts: a token whose label is O whatever its neighbours
are splits a text into chains, and batches of these are decoded in numpy.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, texts_of

KINDS = ("email", "ip", "card", "phone", "name", "id", "tel")
LABELS = ("O", "B-name", "I-name", "B-id", "I-id", "B-tel", "I-tel")
#: Tokens that are decoded at once, in chains that end where no label but O can be best.
DECODED = 128_000
#: Words, and kinds of words, that a worker remembers.
MEMORY = 100_000
#: Marked sentences: [words|kind].
LABELLED = """
My name is [Maria Lopez|name] and I live here.
my name is [John|name]
The name is [Peter van Dijk|name], he said.
Name: [Anna Schmidt|name]
Full name: [Robert James Miller|name]
Customer name: [Linda Park|name] ordered twice.
Name [Claire Dubois|name] was entered.
Dear Mr. [Brown|name], thank you for the order.
Dear Mrs. [Emma Wilson|name], we write about the bill.
Dear [Thomas|name], how are you?
Dear [Priya Nair|name], your parcel is here.
Signed, Mr. [Alan Grant|name]
Please ask Ms. [Julia Stein|name] about it.
Dr. [Hans Weber|name] will see you now.
Mr [Paul Martin|name] and Mrs [Carla Bruni|name] came.
Our name is [Mark Twain|name] today.
Hello, my name is [Sara|name] and
His name is [Tom Ford|name], she said
Sincerely, [Helen Moore|name]
Yours sincerely, [David O'Neil|name]
Sincerely, [Ana Costa|name]
Kind regards, [Peter Hall|name]
Best regards, [Susan Clarke|name]
Regards, [Omar Haddad|name]
Patient: [Grace Turner|name]
Patient: [Ivan Petrov|name] was seen today.
Patient: [Rosa Diaz|name], born in spring
Contact: [Frank Lutz|name]
Contact: [Mei Chen|name] for the keys.
Tenant: [Nora Jensen|name]
Applicant: [Samuel Adeyemi|name]
Mon nom est [Luc Moreau|name] et voila.
Mein Name ist [Karl Vogel|name] und ich wohne hier.
Mi nombre es [Juan Perez|name] y vivo aqui.
Nombre: [Lucia Gomez|name]
Nom: [Sophie Laurent|name]
Herr [Otto Kruse|name] kommt morgen.
Frau [Petra Lang|name] ruft an.
SSN: [123-45-6789|id]
Her SSN is [987-65-4321|id] on file.
social security number [078-05-1120|id] was found
SSN [219-09-9999|id]
Passport No. [X1234567|id] expires soon.
passport number [C01X00T47|id]
Passport: [AB123456|id]
IBAN [DE89370400440532013000|id] please
IBAN: [GB29 NWBK 6016 1331 9268 19|id]
Call [555-123-4567|tel] today.
Phone: [(555) 123-4567|tel]
Tel. [030 1234567|tel]
tel: [555 123 4567|tel]
My phone is [555-867-5309|tel] at home.
Telephone [020 7946 0958|tel] for help
Fax: [555-222-1111|tel]
Call me at [212-555-0142|tel] please.
The garden and the house. The rest was sold
Was it late and cold then. Perhaps the train that left
The name of the rose is long.
Name the parts of a plant.
The names are not known. We ask again.
Dear all, the meeting is off.
Dear customer, your order has left.
Sincerely yours, the team
Best regards from all of us.
Kind regards to the family.
Patient care is our aim.
The patient: a man of forty, slept well.
Contact us by post. The form is below
Contact: see the last page.
The tenant: who pays, decides.
Call the office on Monday.
Call 3 people and 12 others.
Phone calls cost 25 cents.
The phone was red. It rang twice.
In 1999 and 2004 the 12 teams met.
The total is 1234 of 5678 items.
Chapter 12 shows 345-12 and more.
Licensed under the Apache License, Version 2.0.
Les deux sont la. Une autre fois
Der Name der Stadt. Die Leute
Die Frau und der Herr. Sie kamen
El nombre de la ciudad. Las casas
Le nom de la rue. Rien
build = "0f1e2d3c4b5a69788796a5b4c3d2e1f001234567" here
The passport was lost. It took days
A social security office. The number rose
Section 123-45 of the act
They wrote 9876543210987654 in the text
The 10.20.30.40 to and Of
Und wenn Der Nicht. Auf dem
NOW AND THEN!! WAS!! OF
One | Two | Three | Four
Yes Yes Yes no no no
No. 12 is Red. No. 7 is not.
Is Mr. the short form? Yes
Is. Later came and the
With. Nobody thought of it
On. Both and the
La. Cependant de
Und. Vielleicht der
Est. Toujours et de
By. Morning was the
General Public License
Those of. This. Plainly
""".strip()


DIGIT = re.compile(r"\d")


def shape(w: str) -> str:
    """Classes of the first 24 characters, runs as one: "Xx." for "Hello."."""
    core, end = (w[:-1], w[-1]) if w[-1] in ".,:;!?" else (w, "")
    if core.isalpha() and len(w) < 25:
        if core.islower():
            return "x" + end
        if core[0].isupper() and core[1:].islower():
            return "Xx" + end
    return re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.islower() else "d" if c.isdigit() else c for c in w[:24]))


def form(w: str) -> str:
    """Digits one by one, for tokens that have some."""
    if not DIGIT.search(w):
        return ""
    return "".join("d" if c.isdigit() else "a" if c.isalpha() else c for c in w[:16])


def bare(w: str) -> str:
    return w.lower().strip(".,;:!?()\"'")


def own(w: str, known: set[str] | None) -> list[str]:
    low = bare(w)
    out = [f"s={shape(w)}", f"f={form(w)}", f"e={w[-1:] if w[-1:] in '.,:;!?' else ''}"]
    return out + ([f"w={low}", f"n={low}{out[2][2:]}"] if known is None or low in known else [])


def features(words: list[str], i: int, known: set[str] | None) -> list[str]:
    """Of the word itself all features, of the two before it their words with punctuation only: their shapes prove nothing."""
    at = lambda j: [f for f in own(words[j], known) if f[0] == "n"] if 0 <= j < len(words) else []
    return [f"0{f}" for f in own(words[i], known)] + [f"-{f}" for f in at(i - 1)] + [f"={f}" for f in at(i - 2)] + ["b"]


def marked(line: str) -> tuple[list[str], list[int]]:
    words, labels = [], []
    for m in re.finditer(r"\[([^|\]]*)\|(\w+)\](\S*)|\S+", line):
        if m[2]:
            ws = m[1].split()
            ws[-1] += m[3]
            words += ws
            labels += [LABELS.index(f"{'B' if k == 0 else 'I'}-{m[2]}") for k in range(len(ws))]
        else:
            words.append(m[0])
            labels.append(0)
    return words, labels


def strange_lines(n: int = 200, seed: int = 3) -> list[str]:
    """Lines of words that are in no table, none of them personal data: a shape alone must not make a name."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = ["".join(rng.choice(list("aeioulnrstdh"), rng.integers(2, 11))) for _ in range(14)]
        words = [w.capitalize() if rng.random() < 0.3 else w.upper() if rng.random() < 0.05 else w for w in words]
        words = [str(rng.choice(["is", "the", "of", "est", "ist", "es", "and", "Is", "The"])) if rng.random() < 0.3 else w for w in words]
        words += words[:1] * int(rng.integers(0, 4))
        out.append(" ".join(w + str(rng.choice(["", "", "", "", ",", "."])) for w in words))
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Rows(dict):
    """word -> its kind: the row of the field's tables that all words of the same features share."""

    def __init__(self, field):
        self.field = field

    def __missing__(self, word: str) -> int:
        got = self[word] = self.field.kind(word)
        return got


class Field:
    """weight: feature -> score of each label; step: score of label after label; known: words with a feature of their own."""

    def __init__(self, weight: dict[str, np.ndarray], step: np.ndarray, known: set[str]):
        self.weight, self.step, self.known = weight, step, known
        self.rows, self.kinds = Rows(self), {}
        self.grids = np.zeros((3, 1024, len(LABELS)), np.float32)
        self.bounds = np.zeros((3, 1024), np.float32)
        self.slack = 2 * max(0.0, float((step - step[0, 0]).max()))
        # most that the transitions to and from a label can gain over those to and from O, whatever its neighbours are
        self.reach = max(0.0, float((np.maximum(0, (step - step[:, :1]).max(axis=0)) + (step - step[:1]).max(axis=1))[1:].max()))

    def total(self, side: str, feats: list[str]) -> np.ndarray:
        return sum((self.weight[f] for f in (f"{side}{x}" for x in feats) if f in self.weight), np.zeros(len(LABELS)))

    def ids(self, words: list[str]) -> np.ndarray:
        """Kinds of words. MEMORY words and as many kinds are remembered from call to call, more only within one."""
        if len(self.rows) > MEMORY:
            self.rows.clear()
        if len(self.kinds) > MEMORY:
            self.rows.clear()
            self.kinds.clear()
            self.grids, self.bounds = self.grids[:, :1024].copy(), self.bounds[:, :1024].copy()
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def kind(self, w: str) -> int:
        # most words are plain ones that no feature knows by name
        f = "x" if w.isalpha() and w.islower() and len(w) < 25 and w not in self.known else tuple(own(w, self.known)) if w else ""
        if (k := self.kinds.get(f)) is None:
            k = self.kinds[f] = len(self.kinds)
            if k == self.bounds.shape[1]:
                self.grids, self.bounds = np.concatenate([self.grids, np.zeros_like(self.grids)], axis=1), np.concatenate([self.bounds, np.zeros_like(self.bounds)], axis=1)
            got = np.array([self.total(side, own(w, self.known) if w else []) for side in "0-="])
            got[0] += self.weight.get("b", 0) if w else np.where(np.arange(len(LABELS)), -100.0, 0.0)
            self.grids[:, k] = got
            self.bounds[:, k] = (got[:, 1:] - got[:, :1]).max(axis=1)
        return k

    def tag(self, texts: list[list[str]]) -> list[list[tuple[int, int, str]]]:
        """(first token, token after the last, kind) of the spans of each text's words."""
        n = np.array([len(ws) for ws in texts], np.int64)
        first = np.cumsum(n + 2) - n - 2
        # two empty words after each text, whose last words are no context of the next
        x = self.ids([w for ws in texts for w in (*ws, "", "")])
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        s, p, pp = self.bounds
        most = s[x]
        most[1:] += p[x[:-1]]
        most[2:] += pp[x[:-2]]
        # chains: from a token that may be other than O to the last such; those with no label that gains over O are all O
        loose = np.flatnonzero(most + self.reach > 0)
        if not len(loose):
            return out
        edge = np.flatnonzero(np.diff(loose) > 1) + 1
        a, z = loose[np.concatenate([[0], edge])], loose[np.concatenate([edge - 1, [len(loose) - 1]])] + 1
        gain = np.maximum.reduceat(most[loose], np.concatenate([[0], edge])) + self.slack > 0
        a, z = a[gain], z[gain]
        order = np.argsort(z - a, kind="stable")
        a, z = a[order], z[order]
        s, p, pp = self.grids
        at = 0
        while at < len(a):
            # chains of about one length, DECODED tokens in all or a single chain; room for an O after the longest
            k = int(np.searchsorted(np.arange(1, len(a) - at + 1) * (z[at:] - a[at:] + 1), DECODED, side="right"))
            some = slice(at, at + max(1, k))
            at = some.stop
            length = z[some] - a[some]
            t = a[some, None] + np.arange(length[-1] + 1)
            inside = np.arange(length[-1] + 1) < length[:, None]
            t = np.where(inside, t, 0)
            e = s[x[t]] + np.where((t > 0)[..., None], p[x[t - 1]], 0) + np.where((t > 1)[..., None], pp[x[t - 2]], 0)
            e[~inside] = np.where(np.arange(len(LABELS)), -100.0, 0.0)
            doc = np.searchsorted(first, a[some], side="right") - 1
            e[:, 0] += np.where((a[some] > first[doc])[:, None], self.step[0], 0)
            path = self.viterbi(e)
            for i, j in zip(*np.nonzero(path % 2 == 1)):
                end = j + 1
                while path[i, end] == path[i, j] + 1:
                    end += 1
                base = int(a[some][i] - first[doc[i]])
                out[doc[i]].append((base + int(j), base + int(end), LABELS[path[i, j]][2:]))
        return [sorted(spans) for spans in out]

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best labels of chains (chains, tokens, labels)."""
        best, back = e[:, 0], np.zeros(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            s = best[:, :, None] + self.step
            back[:, t] = s.argmax(axis=1)
            best = s.max(axis=1) + e[:, t]
        path = np.zeros(e.shape[:2], np.int64)
        path[:, -1] = best.argmax(axis=1)
        for t in range(e.shape[1] - 1, 0, -1):
            path[:, t - 1] = back[np.arange(len(e)), t, path[:, t]]
        return path

    @classmethod
    def fit(cls, lines: list[str], epochs: int = 60, rate: float = 0.1, decay: float = 0.1) -> Field:
        rows = [marked(x) for x in lines]
        known = {bare(w) for ws, ls in rows for w, y in zip(ws, ls) if y == 0 and bare(w).isalpha()}
        feats = [[features(ws, i, known) for i in range(len(ws))] for ws, _ in rows]
        index: dict[str, int] = {}
        x = [[[index.setdefault(f, len(index)) for f in fs] for fs in row] for row in feats]
        k = len(LABELS)
        theta = np.zeros((len(index) + k, k))
        g1, g2 = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, epochs + 1):
            w, step = theta[:-k], theta[-k:]
            grad = -decay * theta
            for row, (_, y) in zip(x, rows):
                e = np.array([w[f].sum(axis=0) for f in row])
                n = len(e)
                a, b = np.zeros((n, k)), np.zeros((n, k))
                a[0] = e[0]
                for i in range(1, n):
                    a[i] = e[i] + log_sum(a[i - 1][:, None] + step, 0)
                for i in range(n - 2, -1, -1):
                    b[i] = log_sum(step + e[i + 1] + b[i + 1], 1)
                z = log_sum(a[-1], 0)
                node = np.exp(a + b - z)
                for i in range(n):
                    d = -node[i]
                    d[y[i]] += 1
                    grad[row[i]] += d
                    if i:
                        grad[-k:] -= np.exp(a[i - 1][:, None] + step + e[i] + b[i] - z)
                        grad[len(index) + y[i - 1], y[i]] += 1
            g1, g2 = 0.9 * g1 + 0.1 * grad, 0.999 * g2 + 0.001 * grad**2
            theta += rate * (g1 / (1 - 0.9**t)) / (np.sqrt(g2 / (1 - 0.999**t)) + 1e-8)
        return cls({f: theta[i] for f, i in index.items()}, theta[-k:], known)


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match starts where a run of digits does, so a search from within one, which would be quadratic, is left out.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LONG = re.compile(r"[0-9](?:[ -]?[0-9]){12}")


def emails(t: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(.[A-Za-z0-9-]+)+ from the left, found from each @: the run before it is the local part."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        a = at
        while a > end and t[a - 1] in LOCAL:
            a -= 1
        if a < at and (m := DOMAIN.match(t, at + 1)):
            out.append((a, m.end()))
            end = m.end()
        at = t.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits[::-1]]
    return sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0


def base_spans(t: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(t)]
    if t.count(".") > 2:
        out += [("ip", *m.span()) for m in IP.finditer(t) if all(len(x) < 4 and int(x or "0") <= 255 for x in (y.lstrip("0") for y in m[0].split(".")))]
    if LONG.search(t):
        for m in CARD.finditer(t):
            d = re.sub("[ -]", "", m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    if "+" in t:
        out += [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def field_spans(texts: list[str], field: Field, base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans of the field in each text that no base span overlaps, without punctuation at their ends."""
    out = []
    for t, found, have in zip(texts, field.tag([t.split() for t in texts]), base):
        at = [m.span() for m in re.finditer(r"\S+", t)] if found else []
        kept = []
        for a, b, kind in found:
            s, e = at[a][0], at[b - 1][1]
            while s < e and t[s] in ".,;:!?\"'":
                s += 1
            while s < e and t[e - 1] in ".,;:!?\"'":
                e -= 1
            if s < e and not any(x < e and s < y for _, x, y in have):
                kept.append((kind, s, e))
        out.append(kept)
    return out


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The counts are of the patterns' spans, base_sha256 is of their list; spans lists those and the field's, n_added counts the latter.
    Null and empty texts have none, and so an empty table gives no rows. Rows may repeat and are each answered, doc_id may be null, other
    columns are ignored, whatever their names. Texts of any length are read whole, by one task.
    """
    small_batches(docs.sparkSession)
    fitted = Field.fit(LABELLED.split("\n") + strange_lines())
    model = (fitted.weight, fitted.step, fitted.known)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    def run(batches):
        field = Field(*model)
        for ids, texts in texts_of(batches):
            rows = []
            texts = [t.decode("utf-8", "surrogatepass") for t in texts]
            bases = [base_spans(t) for t in texts]
            for i, base, more in zip(ids, bases, field_spans(texts, field, bases)):
                rows.append((i, *(sum(s[0] == k for s in base) for k in KINDS[:4]), hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(base + more), len(more)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
