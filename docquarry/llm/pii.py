"""Personal data by bootstrapped contextual extraction, in SQL functions alone.

Seeds.  Four kinds of entities come from fixed patterns with checks (parts of an
address at most 255, Luhn's sum, numbers of digits); these are the base spans.
A fifth kind, secrets, has seeds by their form alone: tokens of hexadecimal
digits, as long as a digest or a key.  Many of those are harmless, so a secret is
a span only where a pattern that was accepted for secrets holds it.  Positions,
which Spark's regular expressions don't give, are sums over the pieces between
the matches.

Bootstrapping.  An occurrence has two lexical patterns: its two words to the
left (three, if two have no letter), and its neighbours on both sides, each of 24
characters of a word at most.  The occurrence itself is no part of them, so they
reach identifiers of any shape; a pattern without a letter is none.
Patterns and instances (surfaces) form a graph whose edges are distinct pairs.
In each round a pattern's confidence in a kind is the sum of its instances'
scores over the number of its instances, of which those that nothing is known
of yet count ``DOUBT`` each; patterns above the threshold that
enough seeds, or instances found before, support give scores to their instances
that are no seeds (noisy or), which support patterns in the next round.  At last,
occurrences of instances with high scores in accepted patterns are spans too.
All of it is grouped aggregation and equi-joins over narrow rows.

What can be discovered, beside the base spans: tokens of 6 to 128 letters, digits
and ``._%+-@`` that hold a digit or an ``@``, and groups of digits with spaces,
brackets or strokes between, of 6 to 64 characters, letters before them included.
A name without a digit is no candidate.

Running time grows with a text's length: the patterns are possessive and start
where a run starts, so a text without white space is read once.  Positions are
sums in blocks of blocks, each level a column of its own (what stands inside a
function of an array is made anew for each of its elements).  Candidates are
compared with the base spans of their neighbourhood, and masks are put into a
block of spans at a time.  What is left of higher growth are steps of a block:
to find its text, and the blocks near it.

Defined results: null text is empty; equal rows get equal spans; null ids are
ids; an empty table gives an empty table; other columns are ignored by
``find_spans`` and kept by ``masked``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, own, small

KINDS = ("email", "ip", "card", "phone")
#: All kinds of spans, and the number that stands for a candidate, which has no kind yet.
NAMES = (*KINDS, "secret")
SECRET, CANDIDATE = len(KINDS), len(NAMES)
#: Seeds of secrets: hexadecimal digits as long as a digest or a key, of either case, with letters and digits.
SECRETS = r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)$"
SECRET_LENGTHS = (32, 40, 48, 56, 64, 96, 128)

#: Equivalents of the contract's patterns that never go back over what they read.
#: ``\G`` lets an address start right after the last one ended within a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "other": r"(?<![A-Za-z0-9._%+@-])(?=[A-Za-z._%+-]*+[0-9@])[A-Za-z0-9._%+@-]{6,128}+(?![A-Za-z0-9._%+@-])",
    "spaced": r"(?<![A-Za-z0-9._%+@()/-])[+(]*+[A-Za-z]{0,4}+[0-9][0-9.-]*+(?:[ ()/]{1,3}+[0-9][0-9.-]*+)++",
}
#: Cheap tests that a text must pass before a pattern is tried on it.
NEEDS = {"email": "contains(t, '@')", "ip": r"d AND t RLIKE '[0-9]\\.[0-9]'", "card": r"d AND t RLIKE '[0-9](?:[ -]?[0-9]){12}'", "phone": "d AND contains(t, '+')", "other": "d OR contains(t, '@')", "spaced": r"d AND t RLIKE '[0-9][.-]*+[ ()/]{1,3}[0-9]'"}
CHECKS = {
    "email": "true",
    "ip": r"forall(split(m, '\\.'), x -> length(ltrim('0', x)) <= 3 AND cast(right(x, 3) AS int) <= 255)",
    "card": "length(translate(m, ' -', '')) BETWEEN 13 AND 19 AND aggregate(sequence(1, length(translate(m, ' -', ''))), 0, (a, i) -> a + cast(substring('01234567890246813579', cast(substring(translate(m, ' -', ''), -i, 1) AS int) + 1 + 10 * ((i + 1) % 2), 1) AS int)) % 10 = 0",
    "phone": r"length(regexp_replace(m, '[^0-9]', '')) BETWEEN 9 AND 15",
    "other": "true",
    "spaced": "length(m) BETWEEN 6 AND 64",
}
#: What an instance of no known kind counts against a pattern.
DOUBT = 0.2
#: Matches, or sums of blocks of them, in a block.
BLOCK = 128


def _blocked(array: str, step: str) -> str:
    """SQL for ``step`` (of ``b``, where a block begins) over the blocks of an array."""
    return f"transform(sequence(0, greatest(size({array}) - 1, 0), {BLOCK}), b -> {step})"


def _scan(array: str, start: str, fold: str) -> str:
    """SQL for the values of ``fold`` (of ``s`` and ``x``) after each element of an array."""
    s, x = fold.replace("$s", "a.s"), "x"
    step = s.replace("$x", x)
    return f"aggregate({array}, named_struct('s', {start}, 'o', cast(array() AS array<int>)), (a, x) -> named_struct('s', {step}, 'o', array_append(a.o, {step})), a -> a.o)"


def _running(df: DataFrame, names: list[str], fold: str) -> DataFrame:
    """``df`` with the int arrays ``names`` replaced by their running values of ``fold`` (``$s``, ``$x``: a sum or a maximum, from 0 on).

    Each level of blocks is a projection of its own, and its columns are used twice in the next, so none is put into
    the function that uses it.
    """
    whole = f"aggregate(slice({{0}}, b + 1, {BLOCK}), 0, (s, x) -> {fold.replace('$s', 's').replace('$x', 'x')})"
    levels = [{n: n for n in names}]
    for level in (1, 2):
        levels.append({n: f"{n}_{level}" for n in names})
        df = df.withColumns({levels[-1][n]: F.expr(_blocked(levels[-2][n], whole.format(levels[-2][n]))) for n in names})
    df = df.withColumns({f"{n}_up2": F.expr(_scan(levels[2][n], "0", fold)) for n in names})
    for level in (1, 0):
        within = lambda n: _scan(f"slice({levels[level][n]}, {BLOCK} * k + 1, {BLOCK})", f"if(k = 0, 0, {n}_up{level + 1}[greatest(k - 1, 0)])", fold)  # noqa: B023, E731
        df = df.withColumns({f"{n}_up{level}": F.expr(f"flatten(transform(sequence(0, size({n}_up{level + 1}) - 1), k -> {within(n)}))") for n in names})
    return df.withColumns({n: F.col(f"{n}_up0") for n in names}).drop(*[f"{n}{x}" for n in names for x in ("_1", "_2", "_up0", "_up1", "_up2")])


def _occurrences(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``rows`` (column t) with an array column of each kind: structs k, s, e, m and the neighbouring texts l, r."""
    quoted = {k: PATTERNS[k].replace("\\", "\\\\") for k in kinds}
    rows = rows.withColumn("d", F.expr("t RLIKE '[0-9]'"))
    rows = rows.withColumns({f"m_{k}": F.expr(f"CASE WHEN {NEEDS[k]} THEN regexp_extract_all(t, '{quoted[k]}', 0) ELSE cast(array() AS array<string>) END") for k in kinds})
    rows = rows.withColumns(
        {f"p_{k}": F.expr(f"CASE WHEN size(m_{k}) > 0 THEN transform(split(t, '{quoted[k]}', -1), p -> named_struct('n', length(p), 'l', substring(p, -48, 48), 'r', left(p, 24))) END") for k in kinds}
    ).drop("d")
    steps = "transform(slice(p_{0}, 1, size(m_{0})), (p, i) -> p.n + if(i > 0, length(m_{0}[i - 1]), 0))"
    rows = rows.withColumns({f"n_{k}": F.expr(f"CASE WHEN size(m_{k}) > 0 THEN {steps.format(k)} ELSE array(0) END") for k in kinds})
    rows = _running(rows, [f"n_{k}" for k in kinds], "$s + $x")
    spans = f"transform(m_{{0}}, (m, i) -> named_struct('k', {{1}}, 's', n_{{0}}[i], 'e', n_{{0}}[i] + length(m), 'm', m, 'l', p_{{0}}[i].l, 'r', p_{{0}}[i + 1].r))"
    checked = {
        k: F.expr(f"CASE WHEN size(m_{k}) > 0 THEN filter({spans.format(k, n)}, h -> {_on('h.m', CHECKS[k])}) ELSE cast(array() AS array<struct<k:int,s:int,e:int,m:string,l:string,r:string>>) END")
        for n, k in enumerate(kinds)
    }
    rows = rows.withColumns(checked)
    return rows.drop(*[f"{x}_{k}" for x in "mpn" for k in kinds])


def _on(value: str, check: str) -> str:
    """The check with its match ``m`` named ``value``."""
    import re

    return re.sub(r"\bm\b", value, check)


def _context(occurrences: Column) -> Column:
    """Occurrences with mask and patterns in place of the neighbouring texts."""
    return F.transform(
        occurrences,
        lambda h: F.struct(
            h["k"].alias("k"), h["s"].alias("s"), h["e"].alias("e"), h["m"].alias("m"),
            F.lower(_before(h["l"])).alias("left"),
            F.lower(F.regexp_extract(h["l"], r"\S{0,24}[ \t]*$", 0)).alias("near"),
            F.lower(F.regexp_extract(h["r"], r"^[ \t]*\S{0,23}", 0)).alias("right"),
        ),
    )


def _before(left: Column) -> Column:
    """The two words before an occurrence, the last may touch it; three, if the two have no letter."""
    two = F.regexp_extract(left, r"(\S{1,24}[ \t]+)?\S{0,24}[ \t]*$", 0)
    return F.when(two.rlike(r"\p{L}"), two).otherwise(F.regexp_extract(left, r"(\S{1,24}[ \t]+){0,2}\S{0,24}[ \t]*$", 0))


def _rows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(df[id_column].alias("id"), F.xxhash64(df[text_column]).alias("th"), F.coalesce(df[text_column], F.lit("")).alias("t"))


def extract(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, th, base, seen``: base spans of each row, and all occurrences with their contexts (seeds and candidates)."""
    rows = _occurrences(_rows(df, id_column, text_column), (*KINDS, "other", "spaced"))
    base = F.flatten(F.array(*[F.col(k) for k in KINDS]))
    rows = rows.withColumn("base", base)
    # A candidate is an identifier-like token, or groups of digits that end where a token ends, that no base span touches;
    # sentence marks at its ends don't belong to it, but a plus before it does.
    whole = "filter(spaced, h -> NOT h.r RLIKE '^[A-Za-z0-9_%+@]')"
    lengths = ", ".join(map(str, SECRET_LENGTHS))
    secret = f"length(h.m) IN ({lengths}) AND h.m RLIKE '{SECRETS}'"
    cut_ends = f"transform(concat(other, {whole}), h -> named_struct('k', if({secret}, {SECRET}, {CANDIDATE}), 's', h.s + length(h.m) - length(ltrim('._%@-', h.m)), 'e', h.e - length(h.m) + length(rtrim('._%+@-', h.m)), 'm', rtrim('._%+@-', ltrim('._%@-', h.m)), 'l', h.l, 'r', h.r))"
    rows = rows.withColumn("candidates", F.expr(cut_ends))
    # Only base spans near a block of candidates are compared with them.
    rows = rows.withColumn("sorted", F.expr("array_sort(transform(base, b -> named_struct('s', b.s, 'e', b.e)))"))
    rows = rows.withColumn("near", F.expr(f"transform({_blocked('sorted', f'slice(sorted, b + 1, {BLOCK})')}, x -> named_struct('s', array_min(transform(x, y -> y.s)), 'e', array_max(transform(x, y -> y.e)), 'x', x))"))
    edges = "transform({}, x -> named_struct('s', array_min(transform(x, h -> h.s)), 'e', array_max(transform(x, h -> h.e)), 'x', x))".format(_blocked("candidates", f"slice(candidates, b + 1, {BLOCK})"))
    beside = f"transform({edges}, c -> named_struct('x', c.x, 'near', flatten(transform(filter(near, y -> y.s < c.e AND c.s < y.e), y -> y.x))))"
    free = F.expr(f"if(size(near) = 0, candidates, flatten(transform({beside}, c -> filter(c.x, h -> NOT exists(c.near, y -> y.s < h.e AND h.s < y.e)))))")
    seen = F.when(F.size("base") + F.size("other") + F.size("spaced") > 0, F.concat("base", free))
    rows = rows.withColumn("seen", seen)
    return rows.select("id", "th", F.expr("transform(base, h -> named_struct('k', h.k, 's', h.s, 'e', h.e))").alias("base"), _context(F.col("seen")).alias("seen"))


def discover(extracted: DataFrame, *, rounds: int = 2, confidence: float = 0.9, seeds: int = 3, doubt: float = DOUBT) -> DataFrame:
    """``id, th, k, s, e``: spans that accepted patterns add.  A pattern needs ``seeds`` distinct seeds of its kind,
    or instances found in the round before, and ``confidence``."""
    seen = extracted.where("size(seen) > 0").select("id", "th", F.explode("seen").alias("h")).select("id", "th", "h.*")
    lexical = F.array(F.concat(F.lit("2 "), "left"), F.concat(F.lit("1 "), "near", F.lit("|"), "right"))
    seen = seen.withColumn("pattern", F.explode(F.filter(lexical, lambda p: p.rlike(r"\p{L}"))))
    # Documents count once for a pair, and a pair once: neither copies nor repetition make support.
    edges = cut(seen.groupBy("pattern", "m", "k").agg(F.count("*").alias("n")).drop("n"))
    seed = edges.where(F.col("k") < CANDIDATE).select("m", "k", F.lit(1.0).alias("score"), "pattern")
    scored = seed
    for _ in range(rounds):
        totals = edges.groupBy("pattern").agg(F.count("*").alias("n"))
        support = scored.groupBy("pattern", "k").agg(F.sum("score").alias("s"), F.count("*").alias("own"))
        told = support.groupBy("pattern").agg(F.sum("own").alias("told"))
        weight = F.col("told") + doubt * (F.col("n") - F.col("told"))
        patterns = support.where(F.col("own") >= seeds).join(told, "pattern").join(totals, "pattern").where(F.col("s") >= confidence * weight)
        patterns = cut(patterns.select("pattern", "k", (F.col("s") / (weight + F.lit(0.1))).alias("c")))
        reached = edges.where(F.col("k") == CANDIDATE).drop("k").join(patterns, "pattern")
        found = reached.groupBy("m", "k").agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score"))
        found = found.groupBy("m").agg(F.max(F.struct("score", "k")).alias("x")).select("m", "x.k", "x.score").where(F.col("score") >= confidence)
        found = cut(found)
        scored = seed.unionByName(edges.where(F.col("k") == CANDIDATE).select("m", "pattern").join(found.withColumn("score", F.least("score", F.lit(0.99))), "m"))
    hits = seen.where(F.col("k") == CANDIDATE).drop("k").join(patterns.select("pattern", "k"), "pattern").join(found.select("m", "k"), ["m", "k"])
    secrets = seen.where(F.col("k") == SECRET).join(patterns.select("pattern", "k"), ["pattern", "k"])
    return hits.select("id", "th", "k", "s", "e").unionByName(secrets.select("id", "th", "k", "s", "e")).distinct()


def find_spans(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """``id, th, base, spans``: base spans and all spans of each row, arrays of (k, s, e) in order."""
    extracted = cut(extract(df, id_column=id_column, text_column=text_column))
    added = discover(extracted, **how).groupBy("id", "th").agg(F.collect_set(F.struct("k", "s", "e")).alias("added"))
    added = added.select(F.col("id").alias("__id"), F.col("th").alias("__th"), "added")
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))
    joined = extracted.select("id", "th", "base").join(added, same, "left")
    return joined.select("id", "th", "base", F.array_sort(F.concat("base", F.coalesce("added", F.expr("cast(array() AS array<struct<k:int,s:int,e:int>>)")))).alias("spans"))


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in NAMES) + ")"
    return F.expr(f"array_join(transform({spans}, h -> {names}[h.k] || ':' || h.s || ':' || h.e), ',')")


def report(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """Counts and a digest of base spans, and all spans as text."""
    found = find_spans(df, id_column=id_column, text_column=text_column, **how)
    counts = [F.expr(f"cast(size(filter(base, h -> h.k = {n})) AS long)").alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return found.select(F.col("id").alias(id_column), *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def masked(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """``df`` with each span of its texts replaced by its kind in angle brackets; of overlapping spans the first, and the
    longest that starts there, gives the name.

    Only rows with spans are joined; the others keep their texts as they are.
    """
    key, hashed, spans, row_hash, ends = own("id", "th", "spans", "row_th", "ends")
    found = find_spans(df, id_column=id_column, text_column=text_column, **how)
    found = found.where("size(spans) > 0").groupBy("id", "th").agg(F.first("spans").alias("spans"))
    found = found.select(F.col("id").alias(key), F.col("th").alias(hashed), F.col("spans").alias(spans))
    found = found.withColumn(spans, F.expr(f"array_sort(transform({spans}, h -> named_struct('s', h.s, 'o', -h.e, 'e', h.e, 'k', h.k)))"))
    # A span is named if it begins where all before it have ended; what is between goes out as it is.
    found = _running(found.withColumn(ends, F.expr(f"transform({spans}, h -> h.e)")), [ends], "greatest($s, $x)")
    placed = f"transform({spans}, (h, i) -> named_struct('s', h.s, 'e', greatest(h.e, if(i = 0, 0, {ends}[greatest(i - 1, 0)])), 'k', h.k, 'at', if(i = 0, 0, {ends}[greatest(i - 1, 0)])))"
    found = found.withColumn(spans, F.expr(placed)).drop(ends)
    found = small(found.withColumn(spans, F.expr(_blocked(spans, f"slice({spans}, b + 1, {BLOCK})"))))
    names = "array(" + ", ".join(f"'<{k.upper()}>'" for k in NAMES) + ")"
    text = "`" + text_column.replace("`", "``") + "`"
    # Positions are found in the text once for a block of spans, and within the block's text for each of them.
    blocks = f"transform({spans}, x -> named_struct('x', x, 'at', x[0].at, 't', substring({text}, x[0].at + 1, x[size(x) - 1].e - x[0].at)))"
    told = f"transform(filter(c.x, h -> h.s >= h.at), h -> concat(substring(c.t, h.at - c.at + 1, h.s - h.at), {names}[h.k]))"
    last = f"{spans}[size({spans}) - 1]"
    masks = F.expr(f"concat(array_join(transform({blocks}, c -> array_join({told}, '')), ''), substring({text}, {last}[size({last}) - 1].e + 1))")
    rows = df.withColumn(row_hash, F.xxhash64(df[text_column]))
    same = rows[id_column].eqNullSafe(found[key]) & (rows[row_hash] == found[hashed])
    return rows.join(found, same, "left").withColumn(text_column, F.when(F.col(spans).isNull(), F.col(text)).otherwise(masks)).select(*df.columns)
