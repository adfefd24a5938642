"""Surrogates for personal data and secrets, with DataFrame functions only.

Entities are found by one regular expression. Card numbers begin with 2 to 6 and must pass the Luhn check. Each distinct entity (kind, canonical
form) gets one keyed replacement for the whole corpus: digits for digits, hex for hex, a Luhn-valid number for a card,
an address below the reserved domain `example` for an e-mail, a name of the same gender and script for a name. The surrogates are
compared with each other and with all entities found; whoever collides draws again until nothing collides, so different
entities stay different and a surrogate names nobody in the corpus. Mentions get their entity's surrogate in the format they
had (brackets, blanks, dashes, case), so equal entities stay equal.

Names are found after a title or by a first name of the list below; their parts are replaced one by one, so `Ms. Mary Jones`
and `Dr. Jones` keep a surname in common. Bare surnames are not found.

Defined results: null texts stay null and texts without entities stay as they are. Repeated rows give repeated results. All columns
of the input come back; `n_chars`, where there is one, is set anew. Columns for counts get names that the input does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import durable, fresh, named, text_key

_FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra"
_MALE_TITLES = "Mr|Herr|Monsieur|Señor|Sr"
_FEMALE = "Anna|Barbara|Elizabeth|Emma|Hannah|Jennifer|Julia|Laura|Linda|Maria|Marie|Mary|Patricia|Sarah|Sofia|Susan|Анна|Елена|Мария|Ольга"
_MALE = "Carlos|David|Hans|James|Jean|John|José|Juan|Karl|Luis|Michael|Paul|Peter|Pierre|Robert|Thomas|William|Дмитрий|Иван|Павел|Сергей"
_NAME = r"\p{Lu}\p{Ll}++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Kind and pattern; where several match at one place, the first counts.
PATTERNS = {
    # The local part begins where its run of characters begins, so that a long run is looked at once, or right behind an entity.
    # Domain names have at most 127 labels.
    "EMAIL": r"(?:(?<![._%+-])|(?<=\G[._%+-]))[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+){0,126}\.\p{L}{2,}",
    "SECRET": r"(?=[A-Za-z0-9_/+-]{16})(?<=(?:token|secret|passwd|password|api_key|apikey) {0,2}[=:] {0,2}[\"']{0,1})[A-Za-z0-9_/+-]{16,}+"
    r"|(?:[0-9a-f]{40}|(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    "IP": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "PHONE": r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "SSN": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "CARD": r"(?<![\d.-])[2-6](?:[ -]?\d){12,18}(?![\d-])",
    "PERSON": rf"(?=\p{{Lu}}\p{{Ll}})(?<=(?<!\p{{L}})(?:{_FEMALE_TITLES}|{_MALE_TITLES}|Dr|Prof)\.{{0,1}} ){_NAME}(?: {_NAME}){{0,2}}"
    rf"|(?=\p{{Lu}}\p{{Ll}})(?:{_FEMALE}|{_MALE}) {_NAME}",
}
#: Entities begin where no letter or digit stands before; that test first spares most places the rest.
ENTITY = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"

#: Letters for names, by script.
_LETTERS = {
    "latin": ("bdfgklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αειου"),
}
_ENDINGS = {"latin": ("o", "a"), "cyrillic": ("ей", "а"), "greek": ("ος", "α")}
#: Draws before the corpus is declared too rich for a kind's format.
MAX_DRAWS = 40


def _kind(form: Column) -> Column:
    kind = F.lit("PERSON")
    for name in reversed(PATTERNS):
        if name not in ("PERSON", "SECRET"):
            kind = F.when(form.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    secret = form.rlike(r"^[A-Za-z0-9_/+-]{16,}+$") & ~form.rlike(r"^[0-9-]{13,37}$")
    return F.when(form.rlike(f"^(?:{PATTERNS['EMAIL']})$"), F.lit("EMAIL")).when(secret, F.lit("SECRET")).otherwise(kind)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _country(form: Column) -> Column:
    return F.regexp_extract(form, r"^\+\d{1,3}(?=\D)", 0)


def _byte(stream: Column, at: Column) -> Column:
    """The byte number `at` of a hex string of 128 characters, which repeats after 64 bytes."""
    return F.conv(F.substr(stream, 1 + 2 * (at % 64), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), 1 + n % len(letters), F.lit(1))


def _like(text: Column, stream: Column) -> Column:
    """Digits for digits and letters for letters of the same case; the rest stays."""
    chars = F.split(text, "")
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(c.rlike(r"^\d$"), _pick("0123456789", _byte(stream, i)))
            .when(c.rlike("^[a-f]$"), _pick("abcdef", _byte(stream, i)))
            .when(c.rlike("^[A-Z]$"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _byte(stream, i)))
            .when(c.rlike(r"^\p{L}$"), _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i)))
            .otherwise(c),
        ),
        "",
    )


def _name(canonical: Column, kind: Column, stream: Column, draw: Column) -> Column:
    def of(script: str) -> Column:
        soft, vowels = _LETTERS[script]
        male, female = _ENDINGS[script]
        syllables = F.transform(
            F.sequence(F.lit(0), 2 + F.floor(draw / 3).cast("int")),
            lambda _, i: F.concat(_pick(soft, _byte(stream, 2 * i)), _pick(vowels, _byte(stream, 2 * i + 1))),
        )
        end = F.when(kind == "FIRST_F", F.lit(female)).when(kind == "FIRST_M", F.lit(male)).otherwise(_pick(soft, _byte(stream, F.lit(60))))
        return F.concat(F.array_join(syllables, ""), end)

    return (
        F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic"))
        .when(canonical.rlike(r"\p{IsGreek}"), of("greek"))
        .otherwise(of("latin"))
    )


def _luhn_digit(body: Column) -> Column:
    """The digit that makes body + digit pass the Luhn check."""
    reverse = F.split(F.reverse(body), "")
    doubled = F.transform(
        reverse, lambda c, i: F.when(i % 2 == 0, F.expr("array(0,2,4,6,8,1,3,5,7,9)")[c.cast("int")]).otherwise(c.cast("int"))
    )
    return ((F.lit(10) - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _surrogate(kind: Column, canonical: Column, draw: Column, key: str) -> Column:
    stream = F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, draw.cast("string")), 512)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.when(i == 0, 11 + _byte(stream, i) % 200).otherwise(_byte(stream, i))).cast("string"))
    body = F.concat(F.substr(canonical, F.lit(1), F.lit(1)), F.substr(_like(canonical, stream), F.lit(2), F.length(canonical) - 2))
    mail = F.concat(_like(F.substring_index(canonical, "@", 1), stream), F.lit("@"), _like(F.lit("host0000"), F.reverse(stream)), F.lit(".example"))
    return (
        F.when(kind == "EMAIL", mail)
        .when(kind == "IP", F.array_join(octets, "."))
        .when(kind == "CARD", F.concat(body, _luhn_digit(body)))
        .when(kind.isin("PHONE", "SSN", "SECRET"), _like(canonical, stream))
        .otherwise(_name(canonical, kind, stream, draw))
    )


def _rendered(kind: Column, form: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""
    country = F.when(kind == "PHONE", _country(form)).otherwise(F.lit(""))
    rest = F.substr(form, F.length(country) + 1, F.length(form))
    filled = F.array_join(
        F.transform(
            F.split(rest, ""),
            lambda c, i: F.when(
                c.rlike(r"^\d$"), F.substr(surrogate, F.length(_digits(F.substr(rest, F.lit(1), i + 1))), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )
    return (
        F.when(kind.isin("PHONE", "CARD", "SSN"), F.concat(country, filled))
        .when(kind.isin("EMAIL", "IP", "SECRET"), surrogate)
        .otherwise(F.initcap(surrogate))
    )


def _mentions(texts: DataFrame, body: Column) -> DataFrame:
    """(text_key, at, sub, kind, canonical, form) of the entities of every distinct text."""
    found = texts.select(
        text_key(body).alias("text_key"),
        F.posexplode(
            F.zip_with(
                F.regexp_extract_all(body, F.lit(ENTITY), F.lit(0)),
                F.split(body, ENTITY, -1),
                lambda form, gap: F.struct(form.alias("form"), F.right(gap, F.lit(10)).alias("gap")),
            )
        ).alias("at", "m"),
    ).where("m.form is not null")
    found = found.select("text_key", "at", "m.form", "m.gap").withColumn("kind", _kind(F.col("form")))
    found = found.where((F.col("kind") != "CARD") | F.call_function("luhn_check", _digits(F.col("form"))))
    person = F.col("kind") == "PERSON"
    parts = found.select(
        "*", F.posexplode(F.when(person, F.split("form", " ")).otherwise(F.array("form"))).alias("sub", "part")
    )
    first = F.split("form", " ")[0]
    female = first.rlike(f"^(?:{_FEMALE})$") | F.col("gap").rlike(rf"(?:{_FEMALE_TITLES})\.? $")
    male = first.rlike(f"^(?:{_MALE})$") | F.col("gap").rlike(rf"(?:{_MALE_TITLES})\.? $")
    given = person & (F.col("sub") == 0) & F.col("form").contains(" ")
    kind = (
        F.when(given & female, "FIRST_F").when(given & male, "FIRST_M").when(given, "FIRST").when(person, "LAST").otherwise(F.col("kind"))
    )
    part = F.col("part")
    canonical = (
        F.when(kind == "PHONE", _digits(F.substr(part, F.length(_country(part)) + 1, F.length(part))))
        .when(kind.isin("CARD", "SSN"), _digits(part))
        .when(kind.isin("SECRET", "IP"), part)
        .otherwise(F.lower(part))
    )
    rows = parts.select("text_key", "at", "sub", kind.alias("kind"), canonical.alias("canonical"), part.alias("form"))
    return rows.dropDuplicates(["text_key", "at", "sub"])  # copies of a text say the same


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, canonical), distinct, with a surrogate each: no two alike within a kind, none equal to an entity."""
    drawn = entities.withColumn("draw", F.lit(0))
    for _ in range(MAX_DRAWS):
        drawn = durable(drawn.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), F.col("draw"), key)))
        claims = drawn.select("kind", F.col("surrogate").alias("value"), F.col("canonical").alias("by")).unionByName(
            drawn.select("kind", F.col("canonical").alias("value"), F.lit(None).cast("string").alias("by"))
        )
        clashes = (
            claims.groupBy(F.regexp_replace("kind", "^FIRST.*|^LAST", "NAME").alias("family"), F.col("value").alias("surrogate"))
            .agg(F.count("*").alias("n"), F.count("by").alias("claims"), F.min(F.concat_ws("|", "kind", "by")).alias("keeper"))
            .where("claims > 0 and n > 1")
        )
        clashes = durable(clashes)
        if clashes.isEmpty():
            return drawn.select("kind", "canonical", "surrogate")
        family = F.regexp_replace("kind", "^FIRST.*|^LAST", "NAME")
        joined = drawn.withColumn("family", family).join(clashes, ["family", "surrogate"], "left")
        real = F.col("n") > F.col("claims")
        again = F.col("n").isNotNull() & (real | (F.concat_ws("|", "kind", "canonical") != F.col("keeper")))
        drawn = joined.select("kind", "canonical", (F.col("draw") + F.when(again, 1).otherwise(0)).alias("draw"))
    raise ValueError(f"surrogates still collide after {MAX_DRAWS} draws: too many entities of one kind for its format")


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced", kinds: str = "kinds") -> DataFrame:
    """docs with entities replaced, and two more columns: how many were replaced, and their kinds."""
    body = named(docs, text)
    count, kinds = fresh(docs, count, kinds)
    holds = F.coalesce(body.rlike(ENTITY), F.lit(False))
    mentions = durable(_mentions(docs.where(holds), body))
    entities = mentions.select("kind", "canonical").distinct()
    table = surrogate_table(entities, key)
    known = mentions.join(table, ["kind", "canonical"]).select(
        "text_key", "at", "sub", "kind", _rendered(F.col("kind"), F.col("form"), F.col("surrogate")).alias("new")
    )
    whole = known.groupBy("text_key", "at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sub", "new"))), lambda x: x["new"]), " ").alias("new"),
        F.min("kind").alias("kind"),
    )
    per_text = durable(
        whole.groupBy("text_key").agg(
            F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("news"),
            F.sort_array(F.collect_set(F.regexp_replace("kind", "^FIRST.*|^LAST", "PERSON"))).alias("kinds"),
        )
    )
    k, news, their = fresh(docs, "__text_key", "__news", "__kinds")
    per_text = per_text.withColumnsRenamed({"text_key": k, "news": news, "kinds": their})
    joined = docs.where(holds).withColumn(k, text_key(body)).join(per_text, k, "left")
    forms = F.regexp_extract_all(body, F.lit(ENTITY), F.lit(0))
    pieces = F.zip_with(
        F.split(body, ENTITY, -1),
        F.transform(forms, lambda f, i: F.coalesce(F.col(news)[i], f)),
        lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))),
    )
    changed = joined.select(
        *_columns(docs, joined, text, F.array_join(pieces, "")),
        F.coalesce(F.size(news), F.lit(0)).alias(count),
        F.coalesce(F.col(their), F.array().cast("array<string>")).alias(kinds),
    )
    same = docs.where(~holds).select(
        *[named(docs, c) for c in docs.columns], F.lit(0).alias(count), F.array().cast("array<string>").alias(kinds)
    )
    return changed.unionByName(same)


def _columns(docs: DataFrame, joined: DataFrame, text: str, new: Column) -> list[Column]:
    out = []
    for c in docs.columns:
        if c == text:
            out.append(new.alias(c))
        elif c == "n_chars":
            out.append(F.length(new).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(named(joined, c))
    return out
