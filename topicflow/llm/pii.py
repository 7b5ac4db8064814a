"""Replace personal data by keyed surrogates. DataFrame and SQL functions only.

Entities are found by one pattern. Mentions of the same entity (mails in any case, numbers with any separators) have the
same *core* and get the same surrogate wherever they occur. A surrogate is drawn from a keyed digest of the core and fits
the mention: digits stay digits and separators stay in place, card numbers pass the check digit test, mail addresses keep
their shape and top-level domain, names keep gender, script and capitals. Surrogates are compared with each other and
with all entities of the table; whatever collides is drawn again, so different entities stay different. Each further draw is from a larger
space: addresses and names get longer, network addresses leave 10/8 for the reserved block, numbers get further digits after the
fourth. So any number of entities gets surrogates, however few fit their form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.storage import fresh_folder, stored

# a mail address is tried only where a run of its characters begins, so long runs without one cost no more than others
MAIL = r"(?<![A-Za-z0-9À-ɏ._%+-])[A-Za-z0-9À-ɏ._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)"
PHONE = r"\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,4}(?!\d)|(?<![\w])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
CARD = r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
WOMAN = r"Mrs|Ms|Miss|Mme|Frau|Sra|Señora|Госпожа"
MAN = r"Mr|Herr|Monsieur|Sr|Señor|Господин"
NAME = rf"(?<!\w)(?:{WOMAN}|{MAN})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?"
HINTS = ["Mr", "Ms", "Miss", "Mme", "Frau", "Sr", "Señor", "Herr", "Monsieur", "Госп"]  # what a name begins with
PATTERN = f"{MAIL}|{IPV4}|{PHONE}|{IBAN}|{SSN}|{CARD}|{NAME}"
SAME_LENGTH = 4  # draws of a number before it gets further digits

# Syllables that names are made of, by script.
LATIN = "ba be bo da de do fa ga ka la le lo ma me mi na ne no ra re ri ro sa se so ta te ti va vi".split()
GREEK = "βα βε βο δα δε δο γα κα λα λε λο μα με μι να νε νο ρα ρε ρι ρο σα σε σο τα τε τι".split()
CYRILLIC = "ба бе бо да де до фа га ка ла ле ло ма ме ми на не но ра ре ри ро са се со та те ти ва ви".split()


def kind_of(raw: Column) -> Column:
    def whole(pattern: str) -> Column:
        return raw.rlike(f"^(?:{pattern})$")

    return (
        F.when(whole(MAIL), "mail")
        .when(whole(IPV4), "ipv4")
        .when(whole(NAME), F.when(raw.rlike(f"^(?:{WOMAN})(?!\\w)"), "woman").otherwise("man"))
        .when(whole(IBAN), "iban")
        .when(whole(SSN), "ssn")
        .when(raw.startswith("+") | raw.startswith("("), "phone")
        .otherwise("card")
    )


def core_of(kind: Column, raw: Column) -> Column:
    """What makes two mentions the same entity."""
    return (
        F.when(kind == "mail", F.lower(raw))
        .when(kind == "ipv4", raw)
        .when(kind.isin("woman", "man"), F.regexp_replace(raw, r"^\p{L}+\.? ", ""))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .otherwise(F.regexp_replace(raw, r"\D", ""))
    )


DIGEST = "concat(sha2(concat_ws('|', key, 'a', kind, core, attempt), 256), sha2(concat_ws('|', key, 'b', kind, core, attempt), 256))"
_BYTE = "cast(conv(substr(digest, 2 * (({i}) % 64) + 1, 2), 16, 10) as int)"


def _drawn(i: str) -> str:
    """SQL: a byte of the digest, 0 to 255."""
    return _BYTE.format(i=i)


def _shaped(text: str) -> str:
    """SQL: ``text`` with each letter and digit replaced by a keyed one of its sort."""
    return f"""array_join(transform(split({text}, ''), (c, i) -> case
        when c rlike '[0-9]' then cast({_drawn('i')} % 10 as string)
        when c rlike '[a-z]' then char(97 + {_drawn('i')} % 26)
        when c rlike '[A-Z]' then char(65 + {_drawn('i')} % 26)
        when c rlike '[\\\\u00C0-\\\\u024F]' then char(97 + {_drawn('i')} % 26)
        else c end), '')"""


def _syllables(count: int, start: int, ending: str, growing: bool = False) -> str:
    """SQL: a name of ``count`` syllables in the script of the core; one more for each draw if ``growing``."""

    def pick(syllables: list[str], end: str) -> str:
        table = "array(" + ",".join(f"'{s}'" for s in syllables) + ")"
        parts = [f"element_at({table}, 1 + {_drawn(str(start + i))} % {len(syllables)})" for i in range(count)]
        if growing:
            more = f"element_at({table}, 1 + {_drawn('n + 20')} % {len(syllables)})"
            parts.append(f"if(attempt = 0, '', array_join(transform(sequence(1, attempt), n -> {more}), ''))")
        return "concat(" + ",".join([*parts, f"'{end}'"]) + ")"

    latin, cyrillic, greek = ending.split("/")
    return f"""initcap(case when core rlike '\\\\p{{IsCyrillic}}' then {pick(CYRILLIC, cyrillic)}
        when core rlike '\\\\p{{IsGreek}}' then {pick(GREEK, greek)} else {pick(LATIN, latin)} end)"""


_LUHN_SUM = """aggregate(sequence(1, length({d})), 0, (s, i) -> s +
    case when (length({d}) - i) % 2 = 0 then
        case when int(substr({d}, i, 1)) > 4 then 2 * int(substr({d}, i, 1)) - 9 else 2 * int(substr({d}, i, 1)) end
    else int(substr({d}, i, 1)) end)"""


def surrogate() -> Column:
    """SQL over kind, core, attempt, digest: the surrogate's own core."""
    body = _shaped("substr(core, 1, length(core) - 1)")
    check = f"cast((10 - {_LUHN_SUM.format(d='body')} % 10) % 10 as string)"
    card = f"element_at(transform(array({body}), body -> concat(body, {check})), 1)"
    top = "regexp_extract(core, '[.][^.]+$', 0)"
    surname = f"case when core like '% %' then concat(' ', {_syllables(4, 40, 'n/н/ς')}) else '' end"
    more = f"translate(substr(digest, 65, greatest(0, attempt - {SAME_LENGTH})), 'abcdef', '012345')"
    return F.expr(
        f"""case kind
        when 'mail' then concat(substr(digest, 65, attempt), {_shaped("substr(core, 1, length(core) - length(" + top + "))")}, {top})
        when 'ipv4' then concat_ws('.', if(attempt < 2, '10', 240 + {_drawn('3')} % 15), {_drawn('0')}, {_drawn('1')}, {_drawn('2')})
        when 'woman' then concat({_syllables(4, 0, 'na/на/να', True)}, {surname})
        when 'man' then concat({_syllables(4, 0, 'n/н/ς', True)}, {surname})
        when 'card' then concat({card}, {more})
        when 'iban' then concat(substr(core, 1, 2), {_shaped('substr(core, 3)')}, {more})
        when 'phone' then concat(substr(core, 1, 1), {_shaped('substr(core, 2)')}, {more})
        else concat({_shaped('core')}, {more}) end"""
    )


def rendered(kind: Column, raw: Column, core: Column) -> Column:
    """A surrogate core in the dress of the mention: its separators, honorific or capitals."""
    with_marks = F.transform(
        F.split(raw, ""),
        lambda c, i: F.when(
            c.rlike("[A-Za-z0-9]"),
            F.substring(core, F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^A-Za-z0-9]", "")), F.lit(1)),
        ).otherwise(c),
    )
    shown = F.length(F.regexp_replace(raw, "[^A-Za-z0-9]", ""))
    return (
        F.when(kind == "mail", F.when(raw == F.upper(raw), F.upper(core)).otherwise(core))
        .when(kind == "ipv4", core)
        .when(kind.isin("woman", "man"), F.concat(F.regexp_extract(raw, r"^\p{L}+\.? ", 0), core))
        .otherwise(F.concat(F.array_join(with_marks, ""), F.substring(core, shown + 1, F.length(core))))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, core, substitute) for distinct ``entities`` (kind, core): no two alike, none equal to an entity.

    Where surrogates of a kind collide, or meet an entity, all but one of them are drawn again with the next attempt,
    until nothing collides. Every attempt has more values to draw from.
    """
    spark = entities.sparkSession
    core_kind = F.when(F.col("kind").isin("woman", "man"), "name").otherwise(F.col("kind")).alias("family")
    taken = entities.select(core_kind, F.col("core").alias("substitute"), F.lit(True).alias("real"))
    drawn = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = stored(
            drawn.select("kind", "core", "attempt", F.lit(key).alias("key"))
            .withColumn("digest", F.expr(DIGEST))
            .select("kind", "core", "attempt", surrogate().alias("substitute"), core_kind),
            fresh_folder(spark, "surrogates"),
        )
        owner = (
            drawn.groupBy("family", "substitute")
            .agg(F.min(F.struct("attempt", "kind", "core")).alias("owner"))
            .join(taken, ["family", "substitute"], "left")
        )
        judged = drawn.join(owner, ["family", "substitute"]).withColumn(
            "clash", F.col("real").isNotNull() | (F.col("owner") != F.struct("attempt", "kind", "core"))
        )
        judged = stored(judged.select("kind", "core", "attempt", "substitute", "clash"), fresh_folder(spark, "judged"))
        if judged.where("clash").isEmpty():
            return judged.select("kind", "core", "substitute")
        drawn = judged.select("kind", "core", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_entities, kinds) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``text`` has every detected entity replaced, ``kinds`` lists the kinds found in order of place. Null and empty texts
    and texts without entities are unchanged, with 0 and an empty list. Repeated rows and null ids are kept row by row.
    The same ``key`` gives the same surrogates, another one others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # an entity has a digit, an @ or an honorific; texts without them need no search
    hinted = F.col("text").rlike("[0-9@]")
    for hint in HINTS:
        hinted |= F.col("text").contains(hint)
    marked = F.coalesce(hinted & F.col("text").rlike(PATTERN), F.lit(False))
    clean = texts.where(~marked).select(
        "doc_id", "text", F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds")
    )
    held = stored(
        texts.where(marked).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.split("text", PATTERN).alias("gaps"),
            F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("raws"),
        ),
        fresh_folder(spark, "held"),
    )
    mentions = held.select("row", F.posexplode("raws").alias("place", "raw")).withColumn("kind", kind_of(F.col("raw")))
    mentions = stored(
        mentions.withColumn("core", core_of(F.col("kind"), F.col("raw"))), fresh_folder(spark, "mentions")
    )
    chosen = surrogates(mentions.select("kind", "core").distinct(), key)
    replaced = (
        mentions.join(chosen, ["kind", "core"])
        .select(
            "row",
            F.struct(
                "place", "kind", rendered(F.col("kind"), F.col("raw"), F.col("substitute")).alias("shown")
            ).alias("mention"),
        )
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("mention")).alias("mentions"))
    )
    rebuilt = held.join(replaced, "row").select(
        "doc_id",
        F.expr("array_join(flatten(zip_with(gaps, mentions, (g, m) -> array(g, coalesce(m.shown, '')))), '')").alias("text"),
        F.size("mentions").alias("n_entities"),
        F.expr("transform(mentions, m -> m.kind)").alias("kinds"),
    )
    return clean.union(rebuilt)
