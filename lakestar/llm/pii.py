"""Personal data in texts: generators of high recall, boosted trees that judge what they propose.

1. Base kinds (email, ip, card, phone) are exact patterns with a format check. They are always kept.
2. Further generators propose overlapping spans of looser form: numbers inside longer runs, phones
   without a country code, account numbers, disguised addresses.
3. A proposal's features are its format (digits, groups, signs, checksum) and its context (the characters
   around it, words nearby that announce personal data). Each kind has a check of its own (`checks`): Luhn
   for cards from 13 digits, the remainder by 97 for accounts, words that announce a phone, number or
   address, or its disguise. What coincides with a base span or passes is positive, what fails is negative,
   the rest is neither. So that kinds that are rare in the texts are learned too, base spans are rewritten
   into the looser forms: disguised addresses, national phones, shorter cards and accounts, the last two
   also with a wrong check digit, as negatives. At most `SAMPLE` of all these, drawn by hash, are learned from.
4. Isotonic calibration turns tree scores into probabilities; proposals from `THRESHOLD` up that meet no
   base span and did not fail their check are added.

All of it is built-in expressions and Spark's own trees.

Defined results: a null or empty text has no spans. Rows are told apart even if they repeat, and have
equal results then. Ties between proposals are settled by start, longest first. Without enough proposals
of both kinds nothing is added. Other columns of the input are kept, but not
the text, nor one named `spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.boosting import CalibratedTrees
from lakestar.llm.common import staged
from lakestar.llm.spans import ONE, SPAN, fold, ordered, spans

#: Proposals that are learned from, about, and the probability that a proposal needs.
SAMPLE, THRESHOLD = 20_000, 0.8

#: The base patterns, without backtracking over what was matched. A run is entered at its start or
#: where the last match ended, so long runs that match nothing take linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]

#: Looser generators, by the name of the kind that they add.
LOOSE = {
    "email_like": r"[A-Za-z0-9._%+-]{2,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{2,64}(?:(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?|\.)[A-Za-z0-9-]{2,64}){0,3}\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,10}",
    "card_like": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9])",
    "phone_like": r"(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "number_like": r"(?<![A-Za-z0-9])[0-9]{7,19}(?![A-Za-z0-9])",
    "account_like": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KINDS = [*BASE, *LOOSE]
#: Words nearby that announce personal data.
CUES = "(?i)(phone|tel|call|fax|mobile|handy|card|visa|account|iban|konto|compte|cuenta|mail|contact|ssn|passport)"
#: Those that announce a kind, before it.
ANNOUNCE = {
    "email_like": r"(?i)(mail|contact)",
    "phone_like": r"(?i)(phone|tel|call|fax|mobile|handy)",
    "number_like": r"(?i)(phone|tel\b|fax|mobile|handy|card|visa|account|iban|konto|compte|cuenta|ssn|passport)",
}
DISGUISE = r"[(\[](?:at|dot)[)\]]|\x20dot\x20"
CONTEXT = 24
FEATURES = [
    *(f"is_{k}" for k in LOOSE), "length", "digits", "signs", "groups", "spaces", "letters", "plus", "brackets",
    "checksum", "before_blank", "after_blank", "before_joined", "after_joined", "cue", "first_digit", "distinct",
    "passed", "disguised", "blank_dot",
]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    each = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")

    def weighed(d: Column, i: Column) -> Column:
        twice = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(each, weighed), F.lit(0), lambda a, x: a + x)


def luhn(digits: Column) -> Column:
    """Whether digits pass the checksum: from the right, every second one doubled, a multiple of 10."""
    return _luhn_sum(digits) % 10 == 0


def by_97(value: Column) -> Column:
    """The remainder of an account number: blanks left out, the first four characters last, A as 10."""
    solid = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(solid, 5, 64), F.substring(solid, 1, 4))
    each = F.filter(F.split(turned, ""), lambda c: c != "")

    def step(acc: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        return (acc * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(each, F.lit(0), step)


def _announced() -> Column:
    found = [(F.col("kind") == kind) & F.col("before").rlike(words) for kind, words in ANNOUNCE.items()]
    return found[0] | found[1] | found[2]


def checks() -> Column:
    """Whether a proposal passes (true) or fails (false) the check of its kind; null where there is none.
    For the columns kind, value, before and after."""
    kind, value, digits = F.col("kind"), F.col("value"), _digits(F.col("value"))
    glued = F.col("before").rlike(r"[A-Za-z0-9_/=.-]$") | F.col("after").rlike(r"^[A-Za-z0-9_/=-]")
    card = luhn(digits) & F.length(digits).between(13, 19) & digits.rlike("^[3-6]")
    return (
        F.when(kind == "card_like", card)
        .when(kind == "account_like", by_97(value) == 1)
        .when(_announced(), F.lit(True))
        .when(kind == "email_like", value.rlike(DISGUISE))
        .when(kind == "number_like", F.when(~card, F.lit(False)))
        .when((kind == "phone_like") & glued, F.lit(False))
    )


def rewritten(base: DataFrame) -> DataFrame:
    """Base spans (columns kind, value, before, after and others) in the form of looser kinds, with `label`."""
    value, digits = F.col("value"), _digits(F.col("value"))
    form = F.pmod(F.xxhash64("value"), F.lit(3)).cast("int")
    at, dot = (F.element_at(F.array(*(F.lit(x) for x in some)), form + 1) for some in ((" (at) ", "[at]", " at "), (" (dot) ", "[dot]", " dot ")))
    hidden = F.concat(F.substring_index(value, "@", 1), at, F.replace(F.substring_index(value, "@", -1), F.lit("."), dot))
    head = F.substring(digits, F.lit(1), form + 12)
    short = lambda wrong: F.concat(head, ((10 - _luhn_sum(F.concat(head, F.lit("0"))) % 10 + wrong) % 10).cast("string"))
    body = F.rpad(digits, 18, "0")
    rest = by_97(F.concat(F.lit("DE00"), body))
    account = lambda wrong: F.concat(F.lit("DE"), F.lpad((98 - rest + wrong).cast("string"), 2, "0"), body)
    one = lambda kind, text, label: F.struct(F.lit(kind).alias("kind"), text.alias("value"), F.lit(label).alias("label"))
    made = (
        F.when(F.col("kind") == "email", F.array(one("email_like", hidden, 1)))
        .when(F.col("kind") == "phone", F.array(one("phone_like", F.regexp_replace(value, r"^\+[0-9]{1,3}[\x20.-]*", ""), 1)))
        .when(
            F.col("kind") == "card",
            F.array(*(one(k, f(wrong), 1 - wrong) for k, f in (("card_like", short), ("account_like", account)) for wrong in (0, 1))),
        )
    )
    others = [c for c in base.columns if c not in ("kind", "value")]
    rows = base.select(*others, F.explode(made).alias("m")).select(*others, "m.*")
    fits = [(F.col("kind") == kind) & F.col("value").rlike(f"^(?:{pattern})$") for kind, pattern in LOOSE.items()]
    real = F.when(F.col("kind") == "card_like", F.col("value").rlike("^[3-6]") | (F.col("label") == 0)).otherwise(F.lit(True))
    return rows.where((fits[0] | fits[1] | fits[2] | fits[4]) & real)


def _small_parts(value: Column, _: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card_number(value: Column, _: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def _phone_number(value: Column, _: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


def base_spans(text: Column) -> Column:
    return F.concat(
        spans(text, "email", EMAIL),
        spans(text, "ip", IP, _small_parts),
        spans(text, "card", CARD, _card_number),
        spans(text, "phone", PHONE, _phone_number),
    )


def proposals(text: Column) -> Column:
    return F.concat(*(spans(text, kind, pattern) for kind, pattern in LOOSE.items()))


def described(rows: DataFrame) -> DataFrame:
    """The features of the proposals, and their check as `ok`: columns kind, value, before and after."""
    rows = rows.withColumn("ok", checks())
    value, digits = F.col("value"), _digits(F.col("value"))
    number = lambda c: c.cast("double")
    sizes = {
        "length": F.length(value),
        "digits": F.length(digits),
        "signs": F.length(F.regexp_replace(value, r"[A-Za-z0-9\x20]", "")),
        "groups": F.size(F.split(value, "[^0-9]+")),
        "spaces": F.length(F.regexp_replace(value, "[^ ]", "")),
        "letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "plus": value.startswith("+"),
        "brackets": F.contains(value, F.lit("(")),
        "checksum": F.when(F.col("kind") == "account_like", by_97(value) == 1).when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False)),
        "before_blank": F.col("before").rlike(r"(^|\s)$"),
        "after_blank": F.col("after").rlike(r"^(\s|$)"),
        "before_joined": F.col("before").rlike(r"[A-Za-z0-9_/=.:-]$"),
        "after_joined": F.col("after").rlike(r"^[A-Za-z0-9_/=:-]"),
        "cue": F.concat("before", "after").rlike(CUES),
        "first_digit": F.coalesce(F.try_to_number(F.substring(digits, 1, 1), F.lit("9")), F.lit(-1)),
        "distinct": F.size(F.array_distinct(F.split(digits, ""))),
        "passed": F.coalesce("ok", F.lit(False)),
        "disguised": value.rlike(DISGUISE),
        "blank_dot": value.rlike(r"\.\x20|\x20\."),
    }
    kinds = {f"is_{k}": F.col("kind") == k for k in LOOSE}
    return rows.withColumns({name: number(c) for name, c in (kinds | sizes).items()})


def find_personal_data(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """`docs` without the text, with `spans`: kind, start, end and value, by kind as listed, then start."""
    others = [c for c in docs.columns if c.lower() not in ("spans", text.lower())]
    body = F.coalesce(F.col(text), F.lit(""))
    around = lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        F.substring(F.col("_text"), F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))).alias("before"),
        F.substring(F.col("_text"), s["end"] + 1, F.lit(CONTEXT)).alias("after"),
    )
    rows = docs.select(*others, body.alias("_text")).select(
        *others, "_text", base_spans(F.col("_text")).alias("_base"), F.transform(proposals(F.col("_text")), around).alias("_loose")
    )
    rows = rows.withColumn("_near", F.transform("_base", around)).drop("_text")
    # One pass over the texts; from here on there are only spans. Row numbers are fixed by the write.
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "spans")
    loose = rows.select("_row", "_base", F.explode("_loose").alias("s")).select("_row", "_base", "s.*")
    meets = F.exists("_base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    equal = F.exists("_base", lambda b: (b["start"] == F.col("start")) & (b["end"] == F.col("end")))
    loose = described(loose.withColumns({"meets": meets, "equal": equal}))
    label = F.when(F.col("equal"), 1).when(~F.col("meets"), F.col("ok").cast("int"))
    # Proposals are few beside the texts, and read several times.
    loose = staged(loose.select("_row", "start", "end", "kind", "value", "meets", label.alias("label"), *FEATURES), "proposals")
    near = rows.select("_row", F.explode("_near").alias("s")).select("_row", "s.*")

    columns = ["_row", "start", "end", "kind", "label", *FEATURES]
    known = loose.where("label is not null").select(columns).unionByName(described(rewritten(near)).select(columns))
    known = staged(known, "known")
    rate = min(1.0, sample / max(1, known.count()))
    key = F.xxhash64("_row", "start", "end", "kind", "label")
    drawn = F.pmod(key, F.lit(1 << 30)) < int(rate * (1 << 30))
    fold = F.pmod(F.shiftright(key, 40), F.lit(2)).cast("int")
    trees = CalibratedTrees(FEATURES).fit(known.where(drawn).select(*FEATURES, "label", fold.alias("fold")))
    if trees.model is None:
        added = loose.where("false")
    else:
        added = trees.score(loose.where("not meets and coalesce(label, 1) = 1"), "_p").where(F.col("_p") >= THRESHOLD)
    span = F.struct("kind", "start", "end", "value")
    added = added.groupBy("_row").agg(F.collect_list(span).alias("_more"))
    found = F.concat("_base", F.coalesce(_apart(F.col("_more")), F.array().cast(SPAN)))
    return rows.join(added, "_row", "left").select(*others, ordered(found, KINDS, by_kind=True).alias("spans"))


def _apart(found: Column) -> Column:
    """Of overlapping proposals the one that starts first, the longest of those."""
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s.alias("s"))))

    def step(acc: Column, x: Column, _: Column) -> Column:
        free = x["a"] >= acc["state"]
        return F.struct(
            F.when(free, -x["b"]).otherwise(acc["state"]).alias("state"),
            F.when(free, F.array_append(acc["out"], x["s"])).otherwise(acc["out"]).alias("out"),
        )

    move = lambda end, x: F.when(x["a"] >= end, -x["b"]).otherwise(end)
    return F.when(found.isNotNull(), fold(order, F.lit(0), move, step, ONE))


def redact(text: Column, found: Column) -> Column:
    """`text` with each span as its kind in square brackets; of spans that overlap, the whole stretch
    that they cover is replaced by the kind of the first."""
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k"))))

    def stretch(at: Column, items: Column) -> Column:
        """The text from `at` to the end of a block's spans: looking for a place in the whole text takes as long
        as the text."""
        end = F.array_max(F.transform(items, lambda x: x["b"]))
        return F.struct(at.alias("low"), F.substring(text, at + 1, F.greatest(end - at, F.lit(0))).alias("part"))

    def step(acc: Column, x: Column, known: Column) -> Column:
        at = acc["state"]
        between = F.substring(known["part"], at - known["low"] + 1, F.greatest(x["a"] - at, F.lit(0)))
        piece = F.concat(between, F.lit("["), F.upper(x["k"]), F.lit("]"))
        return F.struct(
            F.greatest(at, x["b"]).alias("state"),
            F.when(x["a"] >= at, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    move = lambda at, x: F.greatest(at, x["b"])
    finish = lambda at, out: F.concat(F.array_join(out, ""), F.substring(text, at + 1, F.length(text)))
    return F.when(F.size(found) > 0, fold(order, F.lit(0), move, step, "string", finish, stretch)).otherwise(text)
