"""Personal data replaced by keyed surrogates of the same type. DataFrame functions only.

1. One pattern finds e-mail addresses, phone, card, bank, identity and IP numbers, secrets, and names (a
   title or a known given name with what follows).
2. Each entity breaks into tokens in normal form: a number without its punctuation, an address in
   lower case, a name's parts one by one. One token has one surrogate wherever it stands, so
   mentions that go together still do: "Mr Smith" and "John Smith" share a surname.
3. A surrogate is made of the keyed digest of its token: digits for digits, letters for letters of the
   same script, given names of the same gender and script, valid card and IP numbers.
4. *Collision checks*: a surrogate that two tokens share, or that is itself a token found in the corpus,
   is drawn again, until all are distinct. Names and local parts of addresses grow by a part with each
   draw. Where the format fixes the space (phone and identity numbers, private IP numbers) and it is
   too full for that, the tokens of the format are permuted among all of its values by the key.
5. Each entity takes its tokens' surrogates in its own punctuation and case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import spread_join, stored

# Draws before the tokens of a fixed format are permuted; rounds of that permutation.
DRAWS, MIXES = 8, 8

# Names offered as surrogates, and known as given names.
GIVEN = {
    ("f", "latin"): "Alice Amelie Beatriz Carla Clara Elena Emma Eva Greta Hanna Helga Ines Isabel Jane Julie Karin "
    "Laura Lea Lucia Maria Mia Nora Olga Paula Rosa Sarah Sofia Teresa Ute Vera",
    ("m", "latin"): "Adam Alberto Anton Bruno Carl Daniel David Emil Felix Fritz Georg Hugo Ivan Jacques John Jonas Karl "
    "Leon Luis Marco Max Miguel Oscar Otto Paul Peter Robert Simon Thomas Viktor",
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Софья Татьяна",
    ("m", "cyrillic"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей",
}
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra",
    "m": "Mr Sir Herr Monsieur Señor Sr",
}
SYLLABLES = {
    "latin": "bar bel ber bor dal dan del dor fal fen ger gol hal han hel kel kor lan lem lin mar mel mon nor "
    "pal per ran rol sal sel tal ter tor val ver vin wal wen wil zel",
    "cyrillic": "бар бел вер гор дан дор зел кор лан лем лин мар мел нор пал рад сел тор вал чер",
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}

_NAMES = {key: value.split() for key, value in GIVEN.items()}
_WORD = r"\p{Lu}[\p{L}'’-]+"
_ALL_GIVEN = "|".join(sorted({n for names in _NAMES.values() for n in names}))
_ALL_TITLES = "|".join(t for titles in TITLES.values() for t in titles.split())
_LOCAL = r"\p{L}\p{N}._%+-"
PATTERNS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![0-9]|\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9])\d(?:[ -]?\d){12,18}(?![0-9])",
    "id": r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "phone": r"(?<![0-9])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{3}[ .-]\d{3,4}(?:[ .-]\d{2,4})?(?![0-9])"
    r"|\+\d{7,15}(?![0-9])",
    "person": rf"(?<!\p{{L}})(?:(?:{_ALL_TITLES})\.? {_WORD}(?: {_WORD})?|(?:{_ALL_GIVEN}) {_WORD})(?!\p{{L}})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Stand for the borders of an entity; escaped where a text holds them.
_EDGE, _ESCAPE = "", ""
_NUMBERS = ("phone", "card", "id", "iban")


def pieces(text: Column) -> Column:
    """Plain text and entities in turn: the second, fourth, ... piece is an entity."""
    safe = F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_EDGE), F.lit(_ESCAPE + "a"))
    return F.split(F.regexp_replace(safe, PATTERN, f"{_EDGE}$0{_EDGE}"), _EDGE, -1)


def _joined(parts: Column) -> Column:
    text = F.array_join(parts, "")
    return F.replace(F.replace(text, F.lit(_ESCAPE + "a"), F.lit(_EDGE)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))


def entity_type(entity: Column) -> Column:
    found = F.lit("person")
    for name in reversed([n for n in PATTERNS if n != "person"]):
        found = F.when(F.regexp_like(entity, F.lit(f"^(?:{PATTERNS[name]})$")), name).otherwise(found)
    return found


def _draw(seed: Column, i: Column | int, n: int) -> Column:
    """The i-th keyed number below n. ``seed`` is a hex digest; further numbers come from its own."""
    return F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(n)).cast("int")


def _pick(seed: Column, i: Column | int, choices: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), _draw(seed, i, len(choices)) + 1)


def _letters(word: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters of the same script and case, all else unchanged."""

    def one(c: Column, i: Column) -> Column:
        low = F.lower(c)
        found = F.when(c.between("0", "9"), _draw(seed, i, 10).cast("string"))
        for script, letters in ALPHABETS.items():
            mine = (low >= letters[0]) & (low <= letters[-1])
            if script == "latin":  # with accents; letters of other scripts stay
                mine = mine | ((low >= "ß") & (low <= "ɏ") & (low != "÷"))
            found = found.when(mine, _pick(seed, i, list(letters)))
        return F.when(c != low, F.upper(found.otherwise(c))).otherwise(found.otherwise(c))

    return F.array_join(F.transform(F.split(word, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of a card number, a multiple of 10 for valid ones."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.struct(c.cast("int").alias("d"), (i % 2).alias("odd")))
    twice = lambda x: F.when(x["odd"] == 1, x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"])
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + twice(x))


def _parts(n: Column, seed: Column, choices: list[str], between: str) -> Column:
    """n keyed choices; none for n below 1."""
    at = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(at, lambda i: _pick(seed, i, choices)), between)


def _private(octets: Column) -> Column:
    """How many octets of an IP number say that it is private."""
    return F.when(octets[0] == "10", 1).when((octets[0] == "192") & (octets[1] == "168"), 2).when(
        (octets[0] == "172") & octets[1].cast("int").between(16, 31), 2).otherwise(0)


def fixed_format(kind: Column, token: Column) -> Column:
    """The part that all tokens of a format share, with its length; null where the space is not fixed."""
    octets = F.split(token, r"\.")
    shared = F.array_join(F.slice(octets, F.lit(1), _private(octets)), ".")
    code = F.substr(token, F.lit(1), F.greatest(F.length(token) - 10, F.lit(0)))
    return (
        F.when(kind == "phone", F.concat_ws("|", code, F.length(token).cast("string")))
        .when(kind == "id", "").when((kind == "ip") & (_private(octets) > 0), shared)
    )


def permuted(kind: Column, token: Column, key: str) -> Column:
    """Another value of the token's fixed format: a permutation of all of them without a fixed point.

    The number x of a value goes through alternating keyed sums of its halves, moves on by a keyed
    step and goes back through the same sums.
    """
    octets = F.split(token, r"\.")
    n_octets = 4 - _private(octets)
    is_ip = kind == "ip"
    digits = F.when(kind == "phone", F.least(F.length(token), F.lit(10))).otherwise(F.length(token))
    octet = lambda k: octets[k].cast("long")
    low = F.when(is_ip, F.lit(256)).otherwise(F.pow(F.lit(10), F.floor(digits / 2))).cast("long")
    high = F.when(is_ip, F.when(n_octets == 3, 65536).otherwise(256)).otherwise(
        F.pow(F.lit(10), digits - F.floor(digits / 2))).cast("long")
    x = F.when(is_ip, F.when(n_octets == 3, octet(1) * 65536).otherwise(0) + octet(2) * 256 + octet(3)).otherwise(
        F.substr(token, F.length(token) - digits + 1, digits).cast("long"))
    space = F.concat_ws("|", F.lit(key), F.lit("format"), kind, fixed_format(kind, token))

    def mixed(number: Column, sign: int) -> Column:
        order = list(range(MIXES))[::sign]

        def step(acc: Column, k: Column) -> Column:
            by = lambda half: F.xxhash64(F.sha2(F.concat_ws("|", space, k.cast("string"), half.cast("string")), 256))
            even = k % 2 == 0
            return F.struct(
                F.when(even, F.pmod(acc["hi"] + sign * F.pmod(by(acc["lo"]), high), high)).otherwise(acc["hi"]).alias("hi"),
                F.when(even, acc["lo"]).otherwise(F.pmod(acc["lo"] + sign * F.pmod(by(acc["hi"]), low), low)).alias("lo"),
            )

        start = F.struct(F.floor(number / low).cast("long").alias("hi"), F.pmod(number, low).alias("lo"))
        end = F.aggregate(F.array(*map(F.lit, order)), start, step)
        return end["hi"] * low + end["lo"]

    moved = F.pmod(mixed(x, 1) + F.pmod(F.xxhash64(F.sha2(space, 256)), high * low - 1) + 1, high * low)
    y = mixed(moved, -1)
    byte = lambda k: F.pmod(F.shiftright(y, k), F.lit(256)).cast("string")
    ip = F.when(n_octets == 3, F.concat_ws(".", octets[0], byte(16), byte(8), byte(0))).otherwise(
        F.concat_ws(".", octets[0], octets[1], byte(8), byte(0)))
    number = F.concat(F.substr(token, F.lit(1), F.length(token) - digits), F.lpad(y.cast("string"), digits, F.lit("0")))
    return F.when(is_ip, ip).otherwise(number)


def surrogate(kind: Column, token: Column, attempt: Column, key: str) -> Column:
    """What stands for a token; a pure function of key, token and attempt."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, token, attempt.cast("string")), 256)
    cyrillic = F.regexp_like(token, F.lit(r"\p{IsCyrillic}"))
    body = _letters(token, seed)
    domain = F.substring_index(token, "@", -1)
    domain_seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    top = F.substring_index(domain, ".", -1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    email = F.concat(
        _letters(F.substring_index(token, "@", 1), seed), _parts(attempt - 1, seed, list(ALPHABETS["latin"]), ""), F.lit("@"), _letters(host, domain_seed), F.lit("."), top
    )
    octets = F.split(token, r"\.")
    private = _private(octets)
    ip = F.array_join(
        F.transform(octets, lambda c, i: F.when(i < private, c)
            .when(i == 0, (_draw(seed, i, 116) + 11).cast("string"))  # not among the private ones
            .otherwise((_draw(seed, i, 254) + 1).cast("string"))), "."
    )
    first = F.concat(F.substr(token, F.lit(1), F.lit(1)), F.substr(body, F.lit(2), F.length(token) - 2))
    check = F.pmod(-_luhn(F.concat(first, F.lit("0"))), F.lit(10)).cast("string")
    card = F.when(_luhn(token) % 10 == 0, F.concat(first, check)).otherwise(
        F.concat(F.substr(token, F.lit(1), F.lit(1)), F.substr(body, F.lit(2), F.length(token)))
    )
    # A country code stands before the last ten digits and stays.
    code = F.greatest(F.length(token) - 10, F.lit(0))
    phone = F.concat(F.substr(token, F.lit(1), code), F.substr(body, code + 1, F.lit(10)))
    iban = F.concat(F.substr(token, F.lit(1), F.lit(2)), F.substr(body, F.lit(3), F.length(token)))
    hexa = F.array_join(F.transform(F.split(token, ""), lambda c, i: _pick(seed, i, list("0123456789abcdef"))), "")
    found = (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
        .when(kind == "phone", phone).when(kind == "iban", iban).when(kind == "secret", hexa)
    )
    for gender in ("f", "m"):
        for script, here in (("cyrillic", cyrillic), ("latin", ~cyrillic)):
            # Drawn again, a name gets one part more each time.
            full = _parts(attempt + 1, seed, _NAMES[gender, script], "-")
            found = found.when((kind == f"given_{gender}") & here, full)
    for script, here in (("cyrillic", cyrillic), ("latin", ~cyrillic)):
        parts = _parts(attempt + 3, seed, SYLLABLES[script].split(), "")
        found = found.when(kind.isin("surname", "given_u") & here, F.initcap(parts))
    return found.otherwise(body)


def _tokens(entity: Column, kind: Column) -> Column:
    """(kind, token) of an entity in order."""
    words = F.filter(F.split(entity, " "), lambda w: ~F.rtrim(w, F.lit(".")).isin(_ALL_TITLES.split("|")))
    title = F.rtrim(F.element_at(F.split(entity, " "), 1), F.lit("."))
    first = F.element_at(words, 1)
    women, men = ([n for (g, _), names in _NAMES.items() if g == gender for n in names] for gender in "fm")
    gender = (
        F.when(first.isin(women) | title.isin(TITLES["f"].split()), "given_f")
        .when(first.isin(men) | title.isin(TITLES["m"].split()), "given_m").otherwise("given_u")
    )
    named = F.transform(words, lambda w, i: F.struct(
        F.when(i + 1 < F.size(words), gender).otherwise("surname").alias("kind"), w.alias("token")))
    bare = F.when(kind.isin(*_NUMBERS), F.regexp_replace(entity, r"[^0-9A-Za-z]", "")).otherwise(F.lower(entity))
    return F.when(kind == "person", named).otherwise(F.array(F.struct(kind.alias("kind"), bare.alias("token"))))


def _dressed(entity: Column, kind: Column, found: Column) -> Column:
    """The tokens' surrogates in the entity's punctuation and case."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    value = found[0]

    def step(acc: Column, c: Column) -> Column:
        takes = F.regexp_like(c, F.lit("[0-9A-Za-z]"))
        return F.struct(
            F.concat(acc["out"], F.when(takes, F.substr(value, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (acc["k"] + takes.cast("int")).alias("k"),
        )

    numbers = F.aggregate(F.split(entity, ""), start, step)["out"]
    title = F.regexp_extract(entity, rf"^(?:{_ALL_TITLES})\.? ", 0)
    upper = (entity == F.upper(entity)) & (entity != F.lower(entity)) & kind.isin("email", "person")
    plain = F.when(kind == "person", F.concat(title, F.array_join(found, " "))).when(
        kind.isin(*_NUMBERS), numbers).otherwise(value)
    return F.when(upper, F.upper(plain)).otherwise(plain)


def settled(tokens: DataFrame, key: str) -> DataFrame:
    """kind, token, surrogate: distinct within a kind and never the token itself, nor another token of
    the corpus but where ``permuted`` had to be used."""
    draw = surrogate(F.col("kind"), F.col("token"), F.col("attempt"), key)
    space = fixed_format(F.col("kind"), F.col("token"))
    open_ = tokens.withColumn("attempt", F.lit(0))
    done: DataFrame | None = None
    known = tokens.select(F.col("kind").alias("taken_kind"), F.lower("token").alias("taken"))
    n_draws = 0
    while True:
        drawn = stored(open_.withColumn("surrogate", draw), "drawn")
        used = known
        if done is not None:
            used = known.unionByName(done.select(F.col("kind").alias("taken_kind"), F.lower("surrogate").alias("taken")))
        free = drawn.join(
            used, (F.col("kind") == F.col("taken_kind")) & (F.lower("surrogate") == F.col("taken")), "left_anti"
        )
        # Of tokens that drew the same, the least keeps it.
        least = free.groupBy("kind", F.lower("surrogate").alias("low")).agg(F.min("token").alias("token"))
        won = stored(drawn.join(least.select("kind", "token"), ["kind", "token"]), "settled")
        done = won if done is None else done.unionByName(won)
        open_ = drawn.join(won.select("kind", "token"), ["kind", "token"], "left_anti").select(
            "kind", "token", (F.col("attempt") + 1).alias("attempt")
        )
        if open_.isEmpty():
            return done.select("kind", "token", "surrogate")
        n_draws += 1
        if n_draws == DRAWS:
            # All tokens of a format with open ones are permuted, so that these too stay distinct.
            full = stored(open_.select("kind", space.alias("space")).where("space IS NOT NULL").distinct(), "full-formats")
            again = tokens.withColumn("space", space).join(full, ["kind", "space"], "left_semi").select(
                "kind", "token", F.lit(DRAWS).alias("attempt"), permuted(F.col("kind"), F.col("token"), key).alias("surrogate")
            )
            kept = done.withColumn("space", space).join(full, ["kind", "space"], "left_anti").drop("space")
            done = stored(kept.unionByName(again), "settled")
            open_ = open_.withColumn("space", space).join(full, ["kind", "space"], "left_anti").drop("space")
            if open_.isEmpty():
                return done.select("kind", "token", "surrogate")


def replace_entities(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_entities, text (with surrogates) for every row.

    Null texts are empty; repeated rows give equal rows; other columns are ignored. The same ``key``
    gives the same surrogates for the same corpus.
    """
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    odd = F.filter(pieces(F.col("text")), lambda _, i: i % 2 == 1)
    spots = stored(
        docs.select("doc_id", "text_hash", odd.alias("found")).where(F.size("found") > 0)
        .select("doc_id", "text_hash", F.size("found").alias("n_entities"), F.explode(F.array_distinct("found")).alias("entity")),
        "entities",
    )
    entities = spots.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).withColumn("type", entity_type(F.col("entity")))
    parts = stored(
        entities.select("entity", "n", "type", F.posexplode(_tokens(F.col("entity"), F.col("type"))).alias("at", "t"))
        .select("entity", "n", "type", "at", "t.kind", "t.token"),
        "entity-tokens",
    )
    known = stored(settled(parts.select("kind", "token").distinct(), key), "surrogates")
    whole = parts.join(known, ["kind", "token"]).groupBy("entity", "n", "type").agg(
        F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("found")
    )
    found = F.transform("found", lambda x: x["surrogate"])
    ready = stored(
        whole.select("entity", "n", _dressed(F.col("entity"), F.col("type"), found).alias("stand_in")), "stand-ins"
    )
    met = spread_join(spots, ready, ["entity"], "n", F.struct("doc_id", "text_hash"))
    per_doc = met.groupBy(F.col("doc_id").alias("map_id"), F.col("text_hash").alias("map_hash"), "n_entities").agg(
        F.map_from_entries(F.collect_set(F.struct("entity", "stand_in"))).alias("stand_ins")
    )
    on = F.col("doc_id").eqNullSafe(F.col("map_id")) & (F.col("text_hash") == F.col("map_hash"))
    renewed = F.transform(pieces(F.col("text")), lambda p, i: F.when(i % 2 == 1, F.element_at("stand_ins", p)).otherwise(p))
    return docs.join(per_doc, on, "left").select(
        "doc_id", F.coalesce("n_entities", F.lit(0)).cast("long").alias("n_entities"),
        F.when(F.col("stand_ins").isNull(), F.col("text")).otherwise(_joined(renewed)).alias("text"),
    )
