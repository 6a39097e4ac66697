"""Personal data: pattern matches, and weak supervision for looser candidates.

*Base.* Emails, IP addresses, card numbers (Luhn) and international phone numbers by pattern; all leftmost non-overlapping
matches of each, those that fail their test dropped.

*Candidates.* Looser patterns propose spelled-out addresses (``name (at) host (dot) org``) and grouped or long digit
runs, also right after a label's mark (``Tel:555-123-4567``), that no base span covers.

*Labelers.* Regex, gazetteer and context labelers vote on every base span and candidate: 1 personal, 0 not, -1 no
opinion (``votes``). Votes are aggregated to counts for each vote pattern and feature row (at most a few
thousand rows whatever the corpus; they cover every document) and only these reach the driver.

*Reliabilities.* Expectation-maximisation over the counts estimates each labeler's hit rates in both classes and the prior, without
labelled data; its posteriors train the final span classifier, a logistic regression on the span's shape and the
labelers' votes. Candidates of at least ``THRESHOLD`` are added under their own kind (``contact`` or ``number``).

Everything on the data path is DataFrame functions; EM and the regression run on the bounded table of counts. Defined results: null or
empty text has no spans; repeated rows are scanned each; an empty table gives an empty result (nothing is learnt, nothing is added);
texts of any length are scanned whole, places are code points, end exclusive. Extra columns are left behind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text
from carepulse.llm.spans import find_spans

KINDS = ("email", "ip", "card", "phone", "contact", "number")
THRESHOLD = 0.9
ROUNDS, STEPS = 50, 400

#: The base patterns. Possessive where that can't change a match (nothing that follows could be given
#: back), so that long runs need no stack; a run's inner places are skipped, as a match there would begin earlier.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

_DOT = r"(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
CONTACT = rf"[A-Za-z0-9._%+-]{{2,64}}(?:\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{2,63}}){{1,8}}"
#: A number may follow a label (``Tel:``, ``phone=``, ``Tel.``, ``no-``), but no digit and mark (times, decimals, ratios) and no slash (paths).
NUMBER = r"(?<![0-9A-Za-z+/])(?<![0-9][:=])(?<![^A-Za-z][.-])(?:\([0-9]{2,4}\)\x20?)?[0-9]{2,19}(?:[\x20.-][0-9]{2,4}){0,5}(?![0-9A-Za-z/]|[:=][0-9])"

#: Gazetteers and context words of the labelers.
PROVIDERS = r"(?i)mail|example|gmail|yahoo|outlook|proton|web|post|inbox"
PERSONAL_WORDS = r"(?i)\b(?:tel|phone|call|mobile|cell|fax|contact|e-?mail|mail|ssn|card|visa|account|address|reach|whatsapp)\b"
OTHER_WORDS = r"(?i)\b(?:page|pages|version|isbn|chapter|figure|fig|table|total|year|section|http|vol|no|issue|line|rfc)\b\W*$"
URL = r"//\S*$"
UNITS = r"(?i)^\x20?(?:%|kg|km|cm|mm|eur|usd|dollars|pages|times|years|percent|€|\$)"
DATE = r"^(?:[0-9]{4}[.-][0-9]{2}[.-][0-9]{2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{2,4}|(?:19|20)[0-9]{2})$"
LABELERS = ("pattern", "shape", "gazetteer", "before", "after", "checksum")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The digits pass the Luhn check."""
    parts = F.transform(F.split(F.reverse(number), ""), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(parts, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("order"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                                                 s["value"].alias("value"), s["before"].alias("before"), s["after"].alias("after")))


def base_spans(text: Column) -> Column:
    """array<struct<order, start, end, kind, value, before, after>> by kind, then start."""
    email = find_spans(text, EMAIL, text.contains("@"), near=True)
    ip = F.filter(find_spans(text, IP, near=True), lambda s: s["value"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
    card = F.filter(find_spans(text, CARD, near=True), lambda s: F.length(digits(s["value"])).between(13, 19))
    card = F.filter(card, lambda s: luhn(digits(s["value"])))
    phone = F.filter(find_spans(text, PHONE, text.contains("+"), near=True), lambda s: F.length(digits(s["value"])).between(9, 15))
    return F.array_sort(F.concat(_of_kind(email, "email"), _of_kind(ip, "ip"), _of_kind(card, "card"), _of_kind(phone, "phone")))


def candidates(text: Column, base: Column) -> Column:
    """Looser spans that no base span touches."""
    contact = find_spans(text, CONTACT, text.rlike(r"[(\[]at[)\]]"), near=True)
    number = F.filter(find_spans(text, NUMBER, text.rlike("[0-9]{2}"), near=True), lambda s: F.length(digits(s["value"])).between(6, 19))
    return F.filter(F.array_sort(F.concat(_of_kind(contact, "contact"), _of_kind(number, "number"))),
                    lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(no if no is not None else F.lit(False), 0).otherwise(-1)


def votes(s: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 personal, 0 not, -1 no opinion."""
    value, n = s["value"], F.length(digits(s["value"]))
    numeric = s["kind"].isin("card", "phone", "number")
    return {
        "pattern": _vote(s["kind"].isin("email", "ip", "card", "phone", "contact") | value.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), value.rlike(DATE)),
        "shape": _vote(numeric & n.between(9, 16) & value.rlike(r"[\x20().-]"), numeric & ((n < 9) | ~value.rlike(r"[\x20().+-]"))),
        "gazetteer": _vote(~numeric & value.rlike(PROVIDERS) | numeric & value.rlike(r"\b555\b"), s["before"].rlike(OTHER_WORDS) | numeric & s["before"].rlike(URL)),
        "before": _vote(s["before"].rlike(PERSONAL_WORDS), s["before"].rlike(OTHER_WORDS)),
        "after": _vote(s["after"].rlike(PERSONAL_WORDS), s["after"].rlike(UNITS)),
        "checksum": F.when(numeric & n.between(13, 19), F.when(luhn(digits(value)), 1).otherwise(0)).otherwise(-1),
    }


def shape(s: Column) -> dict[str, Column]:
    """0/1 features of a span besides the votes."""
    value, n = s["value"], F.length(digits(s["value"]))
    return {
        "grouped": value.rlike(r"[0-9][\x20().-]+[0-9]").cast("int"),
        "lettered": value.rlike("[A-Za-z]").cast("int"),
        "short": (n < 9).cast("int"),
        "long": (n > 12).cast("int"),
    }


def reliabilities(table: list[tuple[tuple[int, ...], float]]) -> tuple[float, list[tuple[float, float]], list[float]]:
    """EM over (votes, count) rows: prior, each labeler's chance to vote 1 (given a vote) in class 1 and 0, posteriors."""
    post = [min(0.95, max(0.05, (1 + sum(v == 1 for v in votes_)) / (2 + sum(v >= 0 for v in votes_)))) for votes_, _ in table]
    prior, rates = 0.5, [(0.7, 0.3)] * (len(table[0][0]) if table else 0)
    for _ in range(ROUNDS):
        total = sum(n for _, n in table)
        prior = (sum(p * n for p, (_, n) in zip(post, table)) + 1) / (total + 2)
        rates = []
        for j in range(len(table[0][0])):
            pair = []
            for weight in (post, [1 - p for p in post]):
                said = sum(w * n for w, (v, n) in zip(weight, table) if v[j] >= 0)
                yes = sum(w * n for w, (v, n) in zip(weight, table) if v[j] == 1)
                pair.append((yes, said))
            # two pseudo-votes keep a labeler better than chance until the data say otherwise
            rates.append(((pair[0][0] + 1.4) / (pair[0][1] + 2), (pair[1][0] + 0.6) / (pair[1][1] + 2)))
        new = []
        for v, _ in table:
            a, b = math.log(prior), math.log(1 - prior)
            for j, x in enumerate(v):
                if x >= 0:
                    a += math.log(rates[j][0] if x else 1 - rates[j][0])
                    b += math.log(rates[j][1] if x else 1 - rates[j][1])
            new.append(1 / (1 + math.exp(min(700.0, b - a))))
        post = new
    return prior, rates, post


def fit_logistic(rows: list[tuple[tuple[float, ...], float, float]], l2: float = 1e-3) -> list[float]:
    """Weights (bias first) of a logistic regression on (features, target share, weight) rows, by Newton's method in gradient form."""
    size = len(rows[0][0]) + 1
    w, total = [0.0] * size, sum(n for _, _, n in rows)
    speed = [0.0] * size
    for _ in range(STEPS):
        grad = [l2 * x for x in w]
        for x, y, n in rows:
            z = w[0] + sum(a * b for a, b in zip(w[1:], x))
            e = (1 / (1 + math.exp(-max(-35.0, min(35.0, z)))) - y) * n / total
            grad[0] += e
            for k, b in enumerate(x):
                grad[k + 1] += e * b
        speed = [0.9 * s - 0.5 * g for s, g in zip(speed, grad)]
        w = [a + s for a, s in zip(w, speed)]
    return w


class Scanner:
    """Learns from a whole table; ``scan`` gives its spans."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.rows = id_text(docs, id_col, text_col)
        both = self._both().select(F.explode(F.concat("base", "more")).alias("s"))
        held, extra = votes(F.col("s")), shape(F.col("s"))
        names = [*held, *extra]
        counted = both.select(*[c.alias(k) for k, c in (held | extra).items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("n_")).orderBy(*names).collect()
        table = [(tuple(r[k] for k in LABELERS), float(r["n_"])) for r in counted]
        self.prior, self.rates, post = reliabilities(table) if table else (0.0, [], [])
        self.weights = fit_logistic([(_features(v, [r[k] for k in extra]), p, n) for (v, n), r, p in zip(table, counted, post)]) if table else None

    def _both(self) -> DataFrame:
        found = self.rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
        return found.select("doc_id", "base", candidates(F.col("text"), F.col("base")).alias("more"))

    def probability(self, s: Column) -> Column:
        z = F.lit(self.weights[0])
        terms = [x for v in votes(s).values() for x in ((v == 1).cast("double"), (v == 0).cast("double"))] + [x.cast("double") for x in shape(s).values()]
        for w, x in zip(self.weights[1:], terms):
            z = z + x * w
        return 1 / (1 + F.exp(-z))

    def scan(self) -> DataFrame:
        """Per row: doc_id, base and spans, both array<struct<order, start, end, kind, value, before, after>> by kind, then start."""
        found = self._both()
        more = F.filter("more", lambda s: self.probability(s) >= THRESHOLD) if self.weights else F.slice("more", 1, 0)
        return found.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def _features(vote: tuple[int, ...], extra: list[int]) -> tuple[float, ...]:
    return tuple(float(x) for v in vote for x in (v == 1, v == 0)) + tuple(map(float, extra))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return Scanner(docs, id_col, text_col).scan()
