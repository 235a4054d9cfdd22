"""Personal data by patterns and a linear-chain conditional random field (operator 6).

Base spans come from fixed patterns. Besides, a linear-chain CRF over word-shape features, trained here from
a small labelled table and decoded by Viterbi in numpy batches, marks what the patterns do not have:
secrets (access keys, tokens, passwords), national ids, phone numbers without a country code, masked mail
addresses. Base spans always stay; a CRF span that touches one is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.textbytes import chunks, free_name, small_batches, spans

#: Kinds of the base patterns, and those that only the CRF marks.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id")
STATES = ("out", *KINDS)

# Every pattern reads a text once: an address is looked for from its at sign, and numbers only from where
# their first run of digits begins.
_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[^0-9]+")


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost matches of the local part, an at sign and a domain of two labels at least."""
    if "@" not in text:
        return
    for run in _RUN.finditer(text):
        at, free = text.find("@", run.start(), run.end()), run.start()
        while at >= 0:
            # all characters since the last at sign or match may stand in a local part
            if at > free and (m := _DOMAIN.match(text, at + 1, run.end())):
                yield "email", free, m.end()
                free = m.end()
                at = text.find("@", free, run.end())
            else:
                free = at + 1
                at = text.find("@", free, run.end())


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and then start."""
    out = list(_emails(text))
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p) < 4 and int(p) <= 255 or not p[:-3].strip("0") and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _DIGITS.sub("", m[0])) <= 19 and _luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


# --- the labelled table: text with spans in {kind|...} -------------------------------------------------

# Lines in the forms that the CRF is to know, and plain lines to be left alone. 9 stands for a
# digit, <w> for a word, <n> for a name, <h> for 40 and <x> for 18 hex digits, <k> for 16 capitals and digits,
# <b> for 24 letters and digits of either case, <c> for a number of 16 digits that passes Luhn's test; each line is
# drawn a number of times with others, and with up to four more words at each end.
LABELLED = [
    "<w> <w> {email|<n>.<n>99@<w>9.<w>.com} <w> <w>.",
    "<w> {email|<w>@<w>.org}, <w> <w>",
    "<w> <w> {email|<n> (at) <w> (dot) com} <w> <w>.",
    "<w> {email|<n> [at] <w> [dot] org} <w>",
    "<w> <w> {email|<n>.<n> (at) <w>.com} <w> <w>",
    "<w> {email|<n> at <w> dot com} <w> <w>",
    "<w> mail {email|<n> dot <n> at <w> dot org} <w> <w>",
    "<w> <w> {email|<n> at <w> dot net}, <w>",
    "<w> <w> {ip|199.99.199.99} <w> <w>.",
    "<w> {ip|99.199.99.199}, <w>",
    "<w> <w> {card|<c>} <w> <w>",
    "<w> {card|<c>}, <w> <w>",
    "<w> card {card|9999.9999.9999.9999} <w> <w>",
    "<w> <w> {phone|+9 (999) 999-9999} <w> <w>.",
    "<w> <w> {phone|(999) 999-9999} <w> <w>.",
    "<w> {phone|999-999-9999} <w>",
    "<w> {phone|999.999.9999}, <w> <w>",
    "<w> tel: {phone|999 999 9999} <w>",
    "<w> call {phone|9999999999} <w> <w>",
    "<w> <w> mobile {phone|09999999999} <w>",
    "<w> phone {phone|0999 999999} <w> <w>.",
    "<w> phone {phone|+99 99 9999 9999} <w> <w>",
    "<w> fax: {phone|099-9999999} <w>",
    "<w> <w> token = {secret|\"<h>\"} <w> <w>",
    "<w> token: {secret|<h>} <w>",
    "<w> api_key = {secret|'<x>'} <w> <w>",
    "<w> secret = {secret|<b>} <w>",
    "<w> <w> {secret|password=<x>} <w> <w>",
    "<w> {secret|passwd=<b>} <w> <w>",
    "<w> {secret|api_key=<h>}, <w>",
    "<w> <w> {secret|token=\"<b>\"} <w>",
    "<w> <w> {secret|AKIA<k>} <w> <w>.",
    "<w> {secret|AKIA<k>}, <w> <w>",
    "<w> Bearer {secret|<b>} <w>",
    "<w> <w> {secret|sk-<b>} <w> <w>",
    "<w> {secret|ghp_<b>} <w> <w>.",
    "<w> <w> {id|999-99-9999} <w> <w>",
    "<w> ssn: {id|999-99-9999}, <w>",
    "<w> ssn {id|999 99 9999} <w> <w>",
    "<w> passport {id|A99999999} <w>",
    "<w> passport no. {id|A9999999} <w> <w>",
    "<w> <w>, <w> <w> <w>. <w> <w>",
    "<n> <w> <n> | <w> | <w> |",
    "<w> <w> 99 <w>, 9999 <w> <w>.",
    "<w> version 9.9.9 <w> <w> 9.9 <w>",
    "<w> in 9999 and 9999 <w> <w>.",
    "<w> 99:99:99 <w> 9999-99-99 <w> 99.99.9999 <w>",
    "<w> 99/99/9999 <w> 9999/99 <w>",
    "<w> commit <h> <w> <w>",
    "<w> sha1 <h> <w> md5 <x> <w>",
    "<w> <w> 9999999999999999 <w> <w> <w>",
    "<w> 9999999999999999, <w>",
    "<w> <w> 9999999999999999 | <w>",
    "<w> 9999999999999999 9999999999999999 <w>",
    "<w> 9999999999999999999999999999 <w>",
    "<w> 9999 9999 9999 9999 <w>",
    "<w> id=9999 <w> page=9 <w> x=99.9 <w>",
    "<w> <w> = <w>; <w> = 99; <w>",
    "<w> $ 9,999.99 <w> 99% <w> (9999) <w>",
    "<w> http://<w>.com/<w>/9999 <w> @<w> <w>",
    "<w> at <w> <w>. <w> at the <w> dot <w>",
    "<w> at at at at <w> at <w> at",
    "<w> in at <w> on at <w> <w> at at.",
    "<w> <w> at <w>.<w> <w> at. At <w>, at <n>",
    "<w> <w>&&&<w>***<w> <w>%%%<w> <w>.<n> <w>,<w>",
    "<w> at 99:99 <w> <n> at <n>, <w>",
    "<w> <w>### <w>&&& <w>%%% 99 <w>*** <w>$$$",
    "<w> ### <w> 99-99 <w> 999-999 <w> 9/9 <w>",
    "<w> 999 <w> 9999 <w> <w> 99999 <w>.",
    "<w> 99,999,999 <w> 999 999 <w>",
    "<w> isbn 999-9-99-999999-9 <w> <w>",
    "<w> 999-9-9999-9999-9 <w> <w>",
    "<w> order 9999999 <w> <w>, 999999 <w>.",
    "<w> the token <w> a password <w> key <w>",
    "<w> call <w> 9999 phone <w> <w>",
    "Licensed under CC BY-NC 9.9. <w> <w>",
]

_SOUNDS = ["the", "of", "and", "in", "to", "der", "les", "que", "ción", "ment", "sh", "tion", "er", "on", "an", "re", "bl", "ou", "ich", "ß", "é", "a", "e", "i", "o", "u", "n", "s", "t", "l", "m", "d"]
_HEX, _CAPS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_MIXED = _CAPS + "abcdefghijklmnopqrstuvwxyz"


def labelled_table(spark: SparkSession, draws: int = 6, seed: int = 11) -> DataFrame:
    """text string, spans array<struct<kind, start, end>>: LABELLED, each line drawn ``draws`` times."""
    rows = [_drawn(line, np.random.default_rng([seed, i, k])) for i, line in enumerate(LABELLED) for k in range(draws)]
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>")


def _drawn(line: str, rng: np.random.Generator) -> tuple[str, list]:
    def fresh(m: re.Match) -> str:
        one = lambda letters, n: "".join(letters[i] for i in rng.integers(0, len(letters), n))
        what = m[0]
        if what in ("<w>", "<n>"):
            word = "".join(_SOUNDS[i] for i in rng.integers(0, len(_SOUNDS), rng.integers(1, 9 if rng.random() < 0.1 else 4)))
            return word.capitalize() if rng.random() < (0.5 if what == "<n>" else 0.15) else word
        if what == "<c>":
            body = one("0123456789", 15)
            return body + next(c for c in "0123456789" if _luhn(body + c))
        return {"<h>": lambda: one(_HEX, 40), "<x>": lambda: one(_HEX, 18), "<k>": lambda: one(_CAPS, 16), "<b>": lambda: one(_MIXED, 24), "9": lambda: one("0123456789", 1)}[what]()

    line = " ".join(["<w>"] * rng.integers(0, 5) + [line] + ["<w>"] * rng.integers(0, 5))
    line = re.sub("<[wnhxkbc]>|9", fresh, line)
    text, out, at = "", [], 0
    for m in re.finditer(rf"{{({'|'.join(KINDS)})\|(.*?)}}", line):
        text += line[at : m.start()]
        out.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + line[at:], out


# --- word-shape features ------------------------------------------------------------------------------

_AT = {"at", "(at)", "[at]", "<at>", "{at}"}
_DOT = {"dot", "(dot)", "[dot]", "<dot>", "{dot}"}
# Words that often stand before a number or a key, and last parts of domains.
_CUES = {"tel", "phone", "call", "fax", "mobile", "cell", "telephone", "telefon", "ring", "whatsapp"}
_KEYS = {"token", "password", "passwd", "pwd", "secret", "api_key", "apikey", "key", "access_key", "secret_key", "bearer", "passwort", "auth", "credential"}
_IDS = {"ssn", "passport", "id-card", "licence", "license", "nif", "dni", "ausweis", "social", "security"}
_HASHES = {"commit", "sha1", "sha256", "sha", "md5", "hash", "checksum", "digest", "revision"}
_ENDS = {"com", "org", "net", "edu", "gov", "info"}
_MARKS = ".,;:!?\"'&*%$#|()[]{}<>"


def _features(word: str) -> dict[str, bool]:
    """What holds for a word; its own marks at the ends aside."""
    bare = word.strip(".,;:!?\"'&*%$#|")
    low = bare.lower()
    name, eq, value = bare.partition("=")
    value = value.strip(_MARKS) if eq else bare
    d = sum("0" <= c <= "9" for c in bare)
    a = sum(c.isalpha() for c in bare)
    caps = sum("A" <= c <= "Z" for c in bare)
    dense = len(value) >= 16 and re.fullmatch("[A-Za-z0-9_+/-]+", value) is not None and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    groups = "-".join(str(len(g)) for g in re.findall("[0-9]+", bare)) if d and not a else ""
    return {
        "any": True,
        "letters only": d == 0 and a > 0 and "@" not in bare and "=" not in bare,
        "short word": d == 0 and 0 < a <= 2,
        "long word": d == 0 and a > 15 and "@" not in bare and "=" not in bare,
        "digits only": 0 < d == len(bare),
        "digits and letters": a > 0 and d > 0,
        "address": re.search(r".@[A-Za-z0-9-]+\.", bare) is not None,
        "dotted word": re.fullmatch(r"[A-Za-z][A-Za-z0-9_-]*(\.[A-Za-z0-9_-]+)+", bare) is not None,
        "at word": low in _AT,
        "dot word": low in _DOT,
        "bracketed at or dot": len(low) > 3 and low in _AT | _DOT,
        "domain end": low in _ENDS,
        "ends with domain end": "." in low and low.rpartition(".")[2] in _ENDS,
        "plus first": bare.startswith("+") and d > 0,
        "opens with bracket": bare.startswith("(") and d > 0,
        "four dotted numbers": re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", bare) is not None,
        "dashes": "-" in bare and d > 0 and a == 0,
        "dots": "." in bare and d > 0 and a == 0,
        "slash or colon": any(c in bare for c in "/:") and d > 0,
        "comma or percent": any(c in bare for c in ",%$") and d > 0,
        "3-3-4": groups == "3-3-4",
        "3-2-4": groups == "3-2-4",
        "4-4-4-4": groups == "4-4-4-4",
        "two groups, nine digits or more": groups.count("-") == 1 and d >= 9,
        "leading zero": low.startswith("0") and a == 0 and d > 2,
        "1 or 2 digits": 0 < d <= 2 and a == 0,
        "3 digits": d == 3 and a == 0,
        "4 digits": d == 4 and a == 0,
        "5 or 6 digits": 5 <= d <= 6 and a == 0,
        "7 or 8 digits": 7 <= d <= 8 and a == 0,
        "9 to 12 digits": 9 <= d <= 12 and a == 0,
        "13 to 19 digits": 13 <= d <= 19 and a == 0,
        "20 digits or more": d >= 20 and a == 0,
        "passes Luhn's test": 14 <= d <= 19 and a == 0 and _luhn(_DIGITS.sub("", bare)),
        "letter and 7 or 8 digits": a == 1 and 7 <= d <= 8 and len(bare) == d + 1 and bare[:1].isalpha(),
        "dense": dense,
        "dense hex": dense and re.fullmatch("[0-9a-f]+", value) is not None,
        "dense capitals": dense and caps >= 4 and value.upper() == value,
        "dense, both cases": dense and value.upper() != value and value.lower() != value,
        "known prefix": dense and re.match("AKIA|ASIA|sk-|ghp_|xox|pk_|sk_", value) is not None,
        "assigned": bool(eq) and bool(value) and bool(name),
        "key assigned": bool(eq) and bool(value) and name.lower().strip(_MARKS) in _KEYS,
        "equals or colon": word in ("=", ":", ":=", "=>"),
        "ends with colon": word.endswith(":") and a > 0,
        "phone word": low in _CUES,
        "key word": low in _KEYS,
        "id word": low in _IDS,
        "hash word": low in _HASHES,
    }


FEATURES = list(_features(""))


@lru_cache(maxsize=100_000)
def _shape(word: str) -> tuple[int, ...]:
    """Numbers of the features that hold for a word."""
    return tuple(i for i, x in enumerate(_features(word).values()) if x)


_F = len(FEATURES)
#: A word's own features and those of its neighbours on either side.
_WIDTH = 5


def _rows(words: list[str]) -> np.ndarray:
    """0/1 features [words, 5 * features]: of the words two before to two after."""
    x = np.zeros((len(words) + 4, _F), np.float64)
    for i, w in enumerate(words):
        x[i + 2, list(_shape(w))] = 1
    return np.concatenate([x[k : k + len(words)] for k in range(_WIDTH)], axis=1)


_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def _labels(text: str, found: list) -> tuple[list[str], np.ndarray]:
    tokens = list(_TOKEN.finditer(text))
    y = np.zeros(len(tokens), np.int64)
    for kind, a, b in found:
        for i, t in enumerate(tokens):
            if t.start() < b and t.end() > a:
                y[i] = STATES.index(kind)
    return [t[0] for t in tokens], y


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exp(x) along an axis."""
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


class Crf:
    """weights [5 * features, states], trans [states, states]."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def viterbi(self, emit: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Best states [sequences, time] for emissions [sequences, time, states]; what is past a length is of no meaning.

        Every sequence starts and ends in ``out``.
        """
        n, t, s = emit.shape
        score = self.trans[0][None, :] + emit[:, 0] if t else np.zeros((n, s))
        back = np.zeros((n, t, s), np.int8)
        keep = np.zeros((n, t, s))
        keep[:, 0] = score
        for k in range(1, t):
            all_ = keep[:, k - 1][:, :, None] + self.trans[None]
            back[:, k] = all_.argmax(1)
            keep[:, k] = all_.max(1) + emit[:, k]
        out = np.zeros((n, t), np.int64)
        rows = np.arange(n)
        state = np.zeros(n, np.int64)
        for k in range(t - 1, -1, -1):
            last = length - 1 == k
            end = (keep[:, k] + self.trans[:, 0][None]).argmax(1)
            state = np.where(last, end, state)
            out[:, k] = np.where(k < length, state, 0)
            state = np.where(k < length, back[rows, k, state], state)
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of labelled lines, by forward and backward sums over all of them at once.

        x [lines, time, features], y [lines, time]; what is past a length is of no meaning.
        """
        n, t, s = len(x), x.shape[1], len(self.trans)
        e = (x @ self.weights.astype(x.dtype)).astype(np.float64)
        live = np.arange(t)[None] < length[:, None]
        last = length - 1
        f, b = np.zeros((n, t, s)), np.zeros((n, t, s))
        f[:, 0] = self.trans[0] + e[:, 0]
        for k in range(1, t):
            f[:, k] = _log_sum(f[:, k - 1][:, :, None] + self.trans, 1) + e[:, k]
        b[:] = self.trans[:, 0]
        for k in range(t - 2, -1, -1):
            on = _log_sum(self.trans[None] + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2)
            b[:, k] = np.where((k < last)[:, None], on, b[:, k])
        rows = np.arange(n)
        z = _log_sum(f[rows, last] + self.trans[:, 0], 1)
        p = np.where(live[:, :, None], np.exp(np.minimum(f + b - z[:, None, None], 0)), 0)
        one = np.eye(s)[y] * live[:, :, None]
        gw = x.reshape(n * t, -1).T @ (one - p).reshape(n * t, s).astype(x.dtype)
        gt = np.zeros_like(self.trans)
        gt[0] += (one[:, 0] - p[:, 0]).sum(0)
        gt[:, 0] += (one[rows, last] - p[rows, last]).sum(0)
        for k in range(1, t):
            on = live[:, k]
            both = np.exp(np.minimum(f[on, k - 1][:, :, None] + self.trans + (e[on, k] + b[on, k])[:, None, :] - z[on, None, None], 0))
            gt += np.einsum("na,nb->ab", one[on, k - 1], one[on, k]) - both.sum(0)
        return gw, gt


def train(table: DataFrame, rounds: int = 120, rate: float = 0.2, decay: float = 0.002) -> Crf:
    """Fit a CRF to a small labelled table (text, spans) by Adam on the penalised log-likelihood."""
    lines = [_labels(r.text, [(s.kind, s.start, s.end) for s in r.spans]) for r in table.collect()]
    lines = [(w, s) for w, s in lines if w]
    length = np.array([len(w) for w, _ in lines])
    x, y = np.zeros((len(lines), length.max(initial=1), _WIDTH * _F), np.float32), np.zeros((len(lines), length.max(initial=1)), np.int64)
    for i, (w, s) in enumerate(lines):
        x[i, : len(w)], y[i, : len(w)] = _rows(w), s
    crf = Crf(np.zeros((_WIDTH * _F, len(STATES))), np.zeros((len(STATES), len(STATES))))
    params = [crf.weights, crf.trans]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for k in range(1, rounds + 1):
        g = crf.gradient(x, y, length)
        for i, p in enumerate(params):
            d = g[i] / max(1, len(lines)) - decay * p
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.99 * v[i] + 0.01 * d * d
            p += rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8) * (1 - k / (rounds + 1)) ** 0.5
    return crf


# --- decoding whole texts -----------------------------------------------------------------------------

# Words whose bytes show nothing of interest: letters and plain marks alone, and not one of the cue words.
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PLAIN[[ord(c) for c in ".,;:!?\"'&*%$#|-"]] = True
#: Longer words are looked at whatever they are made of.
LONG = 15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_SECRET = STATES.index("secret")

#: Words taken along on either side of a word that is not plain.
MARGIN = 4


def _crf_spans(crf: Crf, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """CRF spans of each row of a chunk, in code points.

    A plain word surrounded by plain words has the features of ``letters only`` about it and nothing else, for
    which the model gives ``out`` by a wide margin (see test); so the chain is cut there, and Viterbi runs
    over the stretches round all other words.
    """
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    start, end, row = spans(~_SPACE[data], offsets)
    if not len(start):
        return out
    odd = np.concatenate([[0], np.cumsum(~_PLAIN[data])])
    hot = (odd[end] > odd[start]) | (end - start > LONG)
    short = np.flatnonzero((end - start <= 8) & ~hot)
    # cue words in clear: at, dot
    for i in short[np.isin(data[start[short]], [97, 65, 100, 68]) & (end[short] - start[short] <= 3)]:
        if bytes(data[start[i] : end[i]]).lower() in (b"at", b"dot"):
            hot[i] = True
    near = np.flatnonzero(hot)
    if not len(near):
        return out
    take = np.zeros(len(start), bool)
    for k in range(-MARGIN, MARGIN + 1):
        j = near + k
        ok = (j >= 0) & (j < len(start))
        j, own = j[ok], near[ok]
        take[j[row[j] == row[own]]] = True
    idx = np.flatnonzero(take)
    cut = np.flatnonzero((np.diff(idx) > 1) | (np.diff(row[idx]) > 0)) + 1
    seqs = np.split(idx, cut)
    words = [bytes(data[start[i] : end[i]]).decode("utf-8", "replace") for i in idx]
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = 0
    batch: list[tuple[np.ndarray, list[str]]] = []
    for s in seqs:
        batch.append((s, words[at : at + len(s)]))
        at += len(s)
    # sequences of like length go together
    batch.sort(key=lambda p: len(p[0]))
    for i in range(0, len(batch), 512):
        part = batch[i : i + 512]
        length = np.array([len(s) for s, _ in part])
        flat = _flat(crf, [w for _, w in part], length)
        best = crf.viterbi(flat, length)
        for (s, w), states in zip(part, best, strict=True):
            own = states[: len(s)]
            if not own.any():
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if own[a]:
                    r = row[s[a]]
                    base = lead[offsets[r]]
                    lo, hi = int(lead[start[s[a]]] - base), int(lead[end[s[b - 1]]] - base)
                    lo += len(w[a]) - len(w[a].lstrip("\"'.,;:!?|[<*"))
                    hi -= len(w[b - 1]) - len(w[b - 1].rstrip("\"'.,;:!?|]>*%$#&"))
                    if own[a] == _SECRET and b - a == 1:  # the name before an equals sign is none of it
                        name, eq, value = w[a].partition("=")
                        if eq and value.strip(_MARKS):
                            lo = int(lead[start[s[a]]] - base) + len(name) + 1 + len(value) - len(value.lstrip("\"'"))
                    if lo < hi:
                        out[r].append((STATES[own[a]], lo, hi))
    return out


def _flat(crf: Crf, words: list[list[str]], length: np.ndarray) -> np.ndarray:
    """Emissions [sequences, longest, states]: each word adds its weights to itself and its neighbours."""
    t = int(length.max())
    s = len(STATES)
    w = crf.weights.reshape(_WIDTH, _F, s)
    out = np.zeros((len(words), t + 4, s))
    cache: dict[str, np.ndarray] = {}
    for i, own in enumerate(words):
        for k, word in enumerate(own):
            if word not in cache:
                cache[word] = w[:, list(_shape(word))].sum(1)[::-1]
            # window slot j of word k + 2 - j sees this word
            out[i, k : k + _WIDTH] += cache[word]
    return out[:, 2 : t + 2]


def find(docs: DataFrame, crf: Crf, base: str = "base", spans: str = "spans") -> DataFrame:
    """The columns of ``docs`` with ``base`` and ``spans``, arrays of (kind, start, end) in code points, end exclusive.

    Base spans are by kind as listed and then by start; spans holds them and the CRF's in the same order, kinds
    that only the CRF has last. Texts are read whole; a null or empty text has none; repeated rows are read
    apart; an empty table gives an empty one. Columns of ``docs`` with the two names given give way.
    """
    own = [c for c in docs.columns if c not in (base, spans)]
    shared = docs.sparkSession.sparkContext.broadcast(crf)  # some thousand numbers
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    names = ("kind", "start", "end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.schema.get_field_index("text")
            for i, j, data, offsets in chunks(batch.column(col)):
                part = batch.slice(i, j - i)
                texts = part.column(col).to_pylist()
                more = _crf_spans(shared.value, data, offsets)
                found, all_ = [], []
                for text, extra in zip(texts, more, strict=True):
                    b = base_spans(text) if text else []
                    free = [x for x in extra if all(x[1] >= y[2] or x[2] <= y[1] for y in b)]
                    a = sorted([*b, *free], key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
                    found.append([dict(zip(names, x, strict=True)) for x in b])
                    all_.append([dict(zip(names, x, strict=True)) for x in a])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, item), pa.array(all_, item)], names=[*part.schema.names, base, spans])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own]
    kind = "array<struct<kind:string,start:int,end:int>>"
    return small_batches(docs).select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, ", ".join([*fields, f"`{base}` {kind}", f"`{spans}` {kind}"]))


def masked(docs: DataFrame, crf: Crf) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; n_chars, if there, follows the text.

    All other columns, whatever their names, stay as they are; a null or empty text stays too.
    """
    spans = free_name(docs, "spans")
    found = find(docs, crf, free_name(docs, "base"), spans)
    order = F.array_sort(spans, lambda a, b: F.when(a.start < b.start, -1).when(a.start > b.start, 1).otherwise(0))
    zero = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, acc.at + 1, F.greatest(s.start - acc.at, F.lit(0)))
        fresh = s.start >= acc.at
        return F.struct(F.when(fresh, F.concat(acc.done, gap, F.lit("<"), s.kind, F.lit(">"))).otherwise(acc.done).alias("done"), F.greatest(s.end, acc.at).alias("at"))

    clean = F.aggregate(order, zero, step, lambda a: F.concat(a.done, F.substring(text, a.at + 1, F.length(text))))
    out = found.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
