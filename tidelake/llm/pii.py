"""Personal data: fixed patterns, and more spans by weak supervision.

Base spans (email, ip, card, phone) come from fixed patterns and always stay. Other
candidates (national ids, account numbers, phones without a country, credentials, names:
what follows a title, and runs of capitalised words that hold a listed name) are judged:
labelers by format, gazetteer, title, context and shape vote for, against or not at all.
Expectation maximisation over the counts of each combination of votes estimates how often
each labeler is right and how common true spans of each kind are; a labeler that does not
vote says nothing. A naive Bayes classifier over the form of a span (its words and their
shapes, what stands before it) is trained with the posteriors. Spans it gives at least
``THRESHOLD`` are added, unless they overlap a base span. No candidate is bounded in length.

Positions come from cutting a text at the matches: the pieces between them and the
matches alternate, so that their lengths add up to code points. Counts are over all
documents; there is at most one row for each combination of votes and form, whatever the
size of the input. Each text is scanned once: its spans are written beside it, from which
they are counted and then labelled.

Null and empty texts have no spans. Repeated rows are labelled each and count each. An
empty table, or one without candidates, adds no spans. All columns of the input are kept
by ``label`` and ``redact``, but for one named as an output, which is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.tables import written

THRESHOLD = 0.5
ROUNDS = 10_000  # never reached where the reliabilities settle
SETTLED = 1e-6  # of a log odds, between two rounds
SMOOTHING = 1.0
# What is known of a labeler before its votes are seen: so many right and wrong ones.
RIGHT, WRONG = 8.0, 2.0
CONTEXT_CHARS = 32

# The patterns of the contract, in possessive form, which finds the same matches without
# trying a run of characters again from each of its positions. \G: right after a match.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BASE_KINDS = ("email", "ip", "card", "phone")

# What may be personal besides; the kinds of matches are told apart by `_ADDED_FORMS`.
_ID = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
_ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}+(?![A-Za-z0-9])"
_LOCAL_PHONE = r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
_SECRET = r"(?<![A-Za-z0-9])(?=[0-9]*+[A-Za-z])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{16,}+"
# Given names and surnames that are common in the languages of the documents.
GAZETTEER = (
    "Anna|Antonio|Carlos|Carmen|Charles|David|Elena|Emma|Garcia|Hans|James|Jean|John|José|Juan|Klaus|Laura|"
    "Louis|Lucas|Maria|Marie|Martin|Mary|Michael|Müller|Paul|Peter|Pierre|Robert|Schmidt|Smith|Thomas|William"
)

_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme|Mlle)"
# A whole word; a single letter may end in a dot. Runs begin where no word goes on before.
_WORD = r"(?!" + _TITLE + r"(?![\p{L}\p{N}]))\p{Lu}(?:[\p{L}'-]++(?![\p{L}\p{N}])|\.)"
_BEGIN = r"(?=\p{Lu})(?<![\p{L}\p{N}'-])"
_TITLED = rf"(?=[DFHMPS]){_BEGIN}{_TITLE}\.? {_WORD}(?: {_WORD})?"
# Up to two words before the listed name and two after it.
_LISTED = rf"{_BEGIN}(?:{_WORD} ){{0,2}}?(?:{GAZETTEER})(?![\p{{L}}\p{{N}}])(?: {_WORD}){{0,2}}"
_NAME = f"{_TITLED}|{_LISTED}"
# All of these hold a digit.
_NUMBERED = f"{_ID}|{_ACCOUNT}|{_LOCAL_PHONE}|{_SECRET}"
_ADDED_FORMS = (
    ("id", r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    ("local_phone", r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}$"),
    ("account", r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}+$"),
    ("name", r"^[^0-9]+$"),
)
ADDED_KINDS = ("account", "id", "local_phone", "name", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

# Words that stand before personal data, in the languages of the documents.
CUES = (
    "account|address|adresse|anrufen|call|card|carta|clave|compte|contact|contacto|contraseña|correo|courriel|"
    "cuenta|email|e-mail|kennwort|key|konto|kontakt|login|mail|mot de passe|nombre|passport|passwort|password|"
    "phone|secret|ssn|tel|telefon|teléfono|téléphone|token|user"
)

# Words of places and houses, which are not persons whatever name they bear.
PLACES = (
    "Avenue|Avenida|Bridge|Calle|Church|College|Company|Gasse|Inc|Institut|Institute|Lane|Ltd|Place|Plaza|Platz|Road|"
    "Rue|Saint|San|Sankt|Santa|School|Square|Straße|Street|University|Weg"
)

SPAN = "struct<kind:string,start:int,end:int,value:string,before:string>"


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """All matches as spans, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        span = F.struct(
            F.lit(kind).alias("kind"),
            begin.alias("start"),
            end.alias("end"),
            pair["value"].alias("value"),
            F.right(pair["gap"], F.lit(CONTEXT_CHARS)).alias("before"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)),
        found,
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.ltrim(part, F.lit("0"))
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(value, r"\."), small)


def _valid_card(value: Column) -> Column:
    """12 to 19 digits whose Luhn sum ends in 0."""
    digits = F.reverse(F.split(_digits(value), ""))

    def weighted(digit: Column, i: Column) -> Column:
        number = digit.cast("int")
        doubled = number * 2
        return F.when(i % 2 == 0, number).when(doubled > 9, doubled - 9).otherwise(doubled)

    # A cut between all characters may leave an empty one at an end.
    kept = F.filter(digits, lambda digit: digit != "")
    luhn = F.aggregate(F.transform(kept, weighted), F.lit(0), lambda total, x: total + x)
    return F.length(_digits(value)).between(12, 19) & (luhn % 10 == 0)


def _valid_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns by start, then kind; null text has none."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    # What a text lacks altogether need not be searched for.
    email = F.when(F.contains(text, F.lit("@")), _matches(text, _EMAIL, "email")).otherwise(none)
    ip = F.filter(_matches(text, _IP, "ip"), lambda s: _valid_ip(s["value"]))
    card = F.filter(_matches(text, _CARD, "card"), lambda s: _valid_card(s["value"]))
    phone = F.when(F.contains(text, F.lit("+")), _matches(text, _PHONE, "phone")).otherwise(none)
    phone = F.filter(phone, lambda s: _valid_phone(s["value"]))
    return F.concat(email, F.when(text.rlike("[0-9]"), F.concat(ip, card, phone)).otherwise(none))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def in_order(spans: Column) -> Column:
    keyed = F.transform(spans, lambda s: F.struct(s["start"], _rank(s["kind"]), s["end"], s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def _added_kind(value: Column) -> Column:
    kind = F.lit("secret")
    for name, form in reversed(_ADDED_FORMS):
        kind = F.when(value.rlike(form), name).otherwise(kind)
    return kind


def with_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns base_spans and candidates, the other spans that may be added."""
    value = F.coalesce(df[text], F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    found = F.concat(
        F.when(value.rlike("[0-9]"), _matches(value, _NUMBERED, "")).otherwise(none),
        # Most texts hold neither a title nor a listed name.
        F.when(value.rlike(f"{_BEGIN}{_TITLE}\\.? |(?=\\p{{Lu}})(?:{GAZETTEER})"), _matches(value, _NAME, "")).otherwise(none),
    )
    both = df.withColumns({"base_spans": base_spans(df[text]), "candidates": found})

    def free(span: Column) -> Column:
        return ~F.exists("base_spans", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    kinds = F.transform("candidates", lambda s: s.withField("kind", _added_kind(s["value"])))
    return both.withColumn("candidates", F.filter(kinds, free))


# Labelers: a vote is 1 for, -1 against, 0 for none.


def _by_format(s: Column) -> Column:
    strict = s["kind"].isin("id", "local_phone", "account") | s["value"].rlike("^(?:AKIA|ASIA|ghp_)")
    plain = (s["kind"] == "secret") & ~s["value"].rlike("^[0-9a-f]+$|^[A-Z0-9]+$")
    return F.when(strict, 1).when(plain, -1).otherwise(0)


def _is_listed(s: Column) -> Column:
    return s["value"].rlike(f"(?<![\\p{{L}}])(?:{GAZETTEER})(?![\\p{{L}}])")


def _is_titled(s: Column) -> Column:
    return s["value"].rlike(f"^{_TITLE}\\.? ")


def _is_place(s: Column) -> Column:
    inside = s["value"].rlike(f"(?<![\\p{{L}}])(?:{PLACES})(?![\\p{{L}}])")
    before = F.lower(s["before"]).rlike(f"(?<![\\p{{L}}])(?:{PLACES.lower()})[ -]$")
    return (s["kind"] == "name") & (inside | before)


def _by_gazetteer(s: Column) -> Column:
    return F.when((s["kind"] == "name") & _is_listed(s) & ~_is_place(s), 1).otherwise(0)


def _by_title(s: Column) -> Column:
    return F.when(_is_titled(s), 1).otherwise(0)


def _by_context(s: Column) -> Column:
    cue = F.lower(s["before"]).rlike(f"(?<![\\p{{L}}])(?:{CUES})[^\\p{{L}}]{{0,12}}$")
    unit = s["before"].rlike(r"[%$€£#]\s?$")
    return F.when(unit, -1).when(cue, 1).otherwise(0)


def _by_shape(s: Column) -> Column:
    letters = F.length(F.regexp_replace(s["value"], r"[^\p{L}]", ""))
    digits = F.length(_digits(s["value"]))
    mixed = (s["kind"] != "name") & (letters > 0) & (digits * 5 >= F.length(s["value"]))
    same = s["value"].rlike(r"^(.)\1+$|(.)\2{7}|0123456|1234567|abcdef")
    return F.when(same | _is_place(s), -1).when(mixed, 1).otherwise(0)


LABELERS = {
    "by_format": _by_format,
    "by_gazetteer": _by_gazetteer,
    "by_title": _by_title,
    "by_context": _by_context,
    "by_shape": _by_shape,
}


# The form of a span, for the classifier: a few values for each name.


def _length(s: Column) -> Column:
    return F.least(F.floor(F.length(s["value"]) / 8), F.lit(5)).cast("string")


def _digit_share(s: Column) -> Column:
    return F.floor(F.length(_digits(s["value"])) * 4 / F.greatest(F.length(s["value"]), F.lit(1))).cast("string")


def _case(s: Column) -> Column:
    lower, upper = s["value"].rlike(r"\p{Ll}"), s["value"].rlike(r"\p{Lu}")
    return F.when(lower & upper, "mixed").when(upper, "upper").when(lower, "lower").otherwise("none")


def _mark(s: Column) -> Column:
    last = F.right(F.rtrim(s["before"]), F.lit(1))
    return F.when(last.rlike("""[=:"']"""), "assigned").when(last == "", "first").otherwise("plain")


def _cue(s: Column) -> Column:
    """The listed word that stands right before, if any."""
    return F.regexp_extract(F.lower(s["before"]), f"(?<![\\p{{L}}])({CUES}|{PLACES.lower()})[^\\p{{L}}]{{0,12}}$", 1)


def _words(s: Column) -> Column:
    return F.least(F.size(F.split(s["value"], r"[\x20.-]+")), F.lit(4)).cast("string")


def _shape(s: Column) -> Column:
    """Runs of capitals, small letters and digits as one letter each, of the first few runs."""
    runs = F.regexp_replace(F.regexp_replace(s["value"], r"\p{Lu}+", "A"), r"[\p{L}&&[^A]]+", "a")
    return F.left(F.regexp_replace(runs, r"[0-9]+", "0"), F.lit(6))


FORM = {
    "length": _length,
    "digit_share": _digit_share,
    "case": _case,
    "mark": _mark,
    "cue": _cue,
    "words": _words,
    "shape": _shape,
    "listed": lambda s: _is_listed(s).cast("string"),
    "titled": lambda s: _is_titled(s).cast("string"),
    "place": lambda s: _is_place(s).cast("string"),
    "kind": lambda s: s["kind"],
}


def _described(s: Column) -> Column:
    parts = {**LABELERS, **FORM}
    return F.struct(*(part(s).cast("string").alias(name) for name, part in parts.items()))


def combinations(spans: DataFrame) -> DataFrame:
    """How often each combination of votes and form occurs among the candidates."""
    one = spans.select(F.explode("candidates").alias("s"))
    described = one.select(_described(F.col("s")).alias("d")).select("d.*")
    return described.groupBy(*LABELERS, *FORM).agg(F.count(F.lit(1)).alias("n"))


def _log_odds(weights: dict[str, dict[str, float]], bias: float, value) -> Column:
    total = F.lit(bias)
    for name, by_value in weights.items():
        if by_value:
            known = F.create_map(*(F.lit(x) for item in sorted(by_value.items()) for x in item))
            total = total + F.coalesce(F.try_element_at(known, value(name)), F.lit(0.0))
    return total


def _weights(counted: DataFrame, probability: Column) -> dict[str, dict[str, float]]:
    """Log odds of each value of each name for each kind, from expected counts of true and other spans.

    The kinds have their own odds, as what tells in one says nothing in another. A value
    is taken to be as common among both as in all, with a weight of ``SMOOTHING`` spans.
    """
    long = counted.select(
        "n",
        "kind",
        probability.alias("p"),
        F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in FORM))).alias("v"),
    )
    rows = (
        long.groupBy("kind", "v.name", "v.value")
        .agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
        .orderBy("kind", "name", "value")
        .collect()  # some values for each kind and name
    )
    whole = {row["kind"]: (row["yes"], row["no"]) for row in rows if row["name"] == "kind"}
    table: dict[str, dict[str, float]] = {name: {} for name in FORM}
    for row in rows:
        yes, no = whole[row["kind"]]
        if row["name"] == "kind":
            table["kind"][row["kind"]] = math.log((yes + SMOOTHING) / (no + SMOOTHING))
        else:
            usual = SMOOTHING * (row["yes"] + row["no"]) / (yes + no)
            table[row["name"]][f"{row['kind']}|{row['value']}"] = math.log(
                (row["yes"] + usual) / (yes + SMOOTHING) * (no + SMOOTHING) / (row["no"] + usual)
            )
    return table


def reliabilities(votes: list[dict]) -> tuple[dict[str, float], dict[str, float]]:
    """The log odds that a vote of each labeler is right, and that a candidate of each kind is true.

    From the count ``n`` of each ``kind`` and combination of votes. A labeler is right as
    often for true spans as for others; what it does not vote on is no evidence. How
    common true spans are is held halfway to even odds, so that no kind is taken whole or
    not at all on few votes.
    """
    voted = [[(name, int(row[name])) for name in LABELERS if int(row[name])] for row in votes]
    trust = dict.fromkeys(LABELERS, math.log(RIGHT / WRONG))
    prior = {row["kind"]: 0.0 for row in votes}
    for _ in range(ROUNDS):
        right, cast = dict.fromkeys(LABELERS, RIGHT), dict.fromkeys(LABELERS, RIGHT + WRONG)
        true, count = dict.fromkeys(prior, SMOOTHING), dict.fromkeys(prior, 2 * SMOOTHING)
        for row, some in zip(votes, voted, strict=True):
            p = 1 / (1 + math.exp(-(prior[row["kind"]] + sum(vote * trust[name] for name, vote in some))))
            true[row["kind"]] += row["n"] * (p + 0.5) / 2
            count[row["kind"]] += row["n"]
            for name, vote in some:
                right[name] += row["n"] * (p if vote > 0 else 1 - p)
                cast[name] += row["n"]
        now = {name: math.log(right[name] / (cast[name] - right[name])) for name in LABELERS}
        common = {kind: math.log(true[kind] / (count[kind] - true[kind])) for kind in prior}
        moved = max(abs(a - b) for a, b in zip([*now.values(), *common.values()], [*trust.values(), *prior.values()], strict=True))
        trust, prior = now, common
        if moved < SETTLED:
            break
    return trust, prior


def fit(counted: DataFrame) -> tuple[dict[str, dict[str, float]], float] | None:
    """Weights and bias of the span classifier from :func:`combinations`."""
    votes = counted.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).orderBy("kind", *LABELERS).collect()  # some hundred rows at most
    if not votes:
        return None
    trust, prior = reliabilities([row.asDict() for row in votes])
    by_vote = {name: {"1": odds, "-1": -odds} for name, odds in trust.items()}
    probability = 1 / (1 + F.exp(-_log_odds({**by_vote, "kind": prior}, 0.0, F.col)))
    return _weights(counted, probability), 0.0


def train(df: DataFrame, text: str = "text") -> tuple[dict[str, dict[str, float]], float] | None:
    """Weights and bias of the span classifier, from all rows; None without candidates."""
    spans = with_spans(df.select(df[text].alias("text")), "text")
    return fit(written(combinations(spans), "combinations"))


def label(df: DataFrame, text: str = "text", model=None, out: str = "pii") -> DataFrame:
    """``df`` with all spans by start, then kind, and base_spans, those of the fixed patterns.

    Without a model one is trained on the rows themselves.
    """
    spans = with_spans(df.drop(out, "base_spans", "candidates"), text)
    if model is None:
        spans = written(spans, "pii-spans")
        model = fit(written(combinations(spans), "combinations"))
    if model is None:
        added = F.array().cast(f"array<{SPAN}>")
    else:
        weights, bias = model

        def likely(s: Column) -> Column:
            def value(name: str) -> Column:
                return s["kind"] if name == "kind" else F.concat(s["kind"], F.lit("|"), FORM[name](s).cast("string"))

            return _log_odds(weights, bias, value) >= math.log(THRESHOLD / (1 - THRESHOLD))

        added = F.filter("candidates", likely)
    return (
        spans.withColumn(out, in_order(F.concat("base_spans", added)))
        .withColumn("base_spans", in_order(F.col("base_spans")))
        .drop("candidates")
    )


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(df: DataFrame, text: str = "text", model=None) -> DataFrame:
    """``df`` with each span of ``text`` replaced by its kind in brackets; overlaps go together."""
    found = label(df, text, model, "pii_spans")
    value = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(value, state["at"] + 1, s["start"] - state["at"])
        parts = F.array(kept, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], F.concat(state["parts"], parts)).otherwise(state["parts"]).alias("parts"),
        )

    def finish(state: Column) -> Column:
        rest = F.substring(value, state["at"] + 1, F.lit(2_000_000_000))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    masked = F.when(F.size("pii_spans") > 0, F.aggregate("pii_spans", start, step, finish)).otherwise(value)
    return found.withColumn(text, masked).drop("pii_spans", "base_spans")
