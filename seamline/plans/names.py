"""Queries over names and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.functions import dictionaries as D
from seamline.functions import text as X
from seamline.operators import names
from seamline.plans import query
from seamline.sources.views import table, view

_TYPES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in D.TYPE_WORDS.items()) + "}"
_listed = lambda words: ", ".join(f"'{w}'" for w in words)
_KINDS = "|".join(sorted(set(D.TYPE_WORDS.values())))


def fold_sql(x: str) -> str:
    return f"strip_accents(replace(replace({x}, 'ß', 'ss'), 'ẞ', 'SS'))"


def spell_sql(x: str) -> str:
    s = f"replace(replace(replace(upper({x}), 'TH', 'T'), 'PH', 'F'), 'DT', 'T')"
    for _ in range(2):
        s = f"regexp_replace({s}, 'C([AOULR])', 'K\\1', 'g')"
    for _ in range(2):
        s = f"regexp_replace({s}, '([A-Z])Y', '\\1I', 'g')"
    return s


def base_sql(x: str) -> str:
    return f"regexp_replace({x}, ' ({_KINDS})$', '')"


def bare_sql(x: str) -> str:
    return f"regexp_replace({x}, '^(({'|'.join(D.LEADING)}) )+(.)', '\\3')"


def turned_sql(x: str) -> str:
    pattern = f"^({'|'.join(D.DIRECTIONS)}) (.)"
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN regexp_replace({x}, '{pattern}', '\\2') END"


def norm_sql(source: str, text: str = "text", prefix: str = "n") -> str:
    """CTEs that add name and typ to ``source``; the last is called ``{prefix}``."""
    fused = " ".join(f"WHEN w[-1] LIKE '%{s}' AND len(w[-1]) - {len(s)} >= 3 THEN '{s}'" for s in D.FUSED_SUFFIXES)
    return f"""
{prefix}0 AS (SELECT *, list_filter(string_split(upper(regexp_replace({fold_sql(text)}, '[^A-Za-z'' ]+', ' ', 'g')), ' '), lambda x: x <> '') AS w0 FROM {source}),
{prefix}1 AS (SELECT *, CASE WHEN len(w0) > 2 AND w0[-1] IN ({_listed(D.DIRECTIONS)}) AND {_TYPES}[w0[-2]] IS NOT NULL THEN w0[1 : len(w0) - 1] ELSE w0 END AS w FROM {prefix}0),
{prefix}2 AS (SELECT *, CASE WHEN {_TYPES}[w[-1]] IS NOT NULL THEN NULL {fused} WHEN w[-1] LIKE '%STR' AND len(w[-1]) >= 7 THEN 'STR' END AS suf FROM {prefix}1),
{prefix}3 AS (SELECT * EXCLUDE (w), CASE WHEN suf IS NULL THEN w ELSE list_concat(w[1 : len(w) - 1], [w[-1][1 : len(w[-1]) - len(suf)], suf]) END AS w FROM {prefix}2),
{prefix}4 AS (SELECT *, CASE WHEN len(w) > 1 THEN {_TYPES}[w[-1]] END AS typ FROM {prefix}3),
{prefix} AS (SELECT * EXCLUDE (w0, suf), array_to_string(CASE WHEN typ IS NULL THEN w ELSE w[1 : len(w) - 1] END, ' ') AS name FROM {prefix}4)"""


_PARTS = """SELECT p_partkey AS tok_id, p_size % 5 AS sheet, p_size % 11 = 0 AS in_block, concat(
  CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name WHEN 2 THEN split_part(upper(p_name), ' ', 1) ELSE split_part(p_name, ' ', 2) END,
  CASE p_size % 10 WHEN 0 THEN ' Street' WHEN 1 THEN ' AVE.' WHEN 2 THEN 'strasse' WHEN 3 THEN ' Rd E' WHEN 4 THEN '-Platz' WHEN 5 THEN 'str'
    WHEN 6 THEN ' & Co' WHEN 7 THEN ' BLK 50' WHEN 8 THEN ' 12' ELSE '' END) AS text FROM {part}"""


def tokens(spark, d):
    return spark.sql(_PARTS, part=table(spark, d, "part"))


_T = f"t AS ({_PARTS.replace('{part}', 'part')})"


@query(f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents")
def fold_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fold(F.col("text")).alias("folded"))


@query(f"WITH {_T}, {norm_sql('t')} SELECT tok_id, name, typ, concat_ws(' ', name, typ) AS canon FROM n")
def norm_label(spark, d):
    label = X.norm_label(F.col("text"))
    return tokens(spark, d).select("tok_id", label["name"].alias("name"), label["typ"].alias("typ"), X.canon(F.col("text")).alias("canon"))


@query(f"WITH {_T} SELECT DISTINCT text, {spell_sql('text')} AS key FROM t")
def spell_key(spark, d):
    return tokens(spark, d).select("text", X.spell_key(F.col("text")).alias("key")).distinct()


@query(r"""
WITH t AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN concat('BLOCK ', p_size) WHEN 1 THEN concat(p_size % 5, '½') WHEN 2 THEN concat('blk. ', p_size)
  WHEN 3 THEN concat(p_name, ' BLK') WHEN 4 THEN concat(' ', p_size % 4, ' ') ELSE concat(p_size % 5, '1/2') END AS text FROM part),
n AS (SELECT id, nullif(regexp_extract(trim(text), '^(?i:BL(?:OC)?K\.?\s+)?([0-9]+(?:½|1/2)?)$', 1), '') AS number FROM t),
f AS (SELECT *, TRY_CAST(regexp_extract(number, '^([0-9]{1,4})(?:½|1/2)?$', 1) AS DOUBLE) + CASE WHEN regexp_matches(number, '(½|1/2)$') THEN 0.5 ELSE 0 END AS v FROM n)
SELECT id, number, CASE WHEN v >= 1 AND v <= 3 THEN v END AS floors FROM f
""")
def numerals(spark, d):
    text = F.expr("""CASE p_partkey % 6 WHEN 0 THEN concat('BLOCK ', p_size) WHEN 1 THEN concat(p_size % 5, '½') WHEN 2 THEN concat('blk. ', p_size)
      WHEN 3 THEN concat(p_name, ' BLK') WHEN 4 THEN concat(' ', p_size % 4, ' ') ELSE concat(p_size % 5, '1/2') END""")
    number = table(spark, d, "part").select(F.col("p_partkey").alias("id"), X.numeral(text).alias("number"))
    return number.select("id", "number", X.floors(F.when(F.col("number").isNotNull(), F.array("number")).otherwise(F.array().cast("array<string>"))).alias("floors"))


_SCALES = """SELECT p_partkey AS tok_id, p_size % 7 AS sheet, CASE p_partkey % 5 WHEN 0 THEN concat('SCALE ', p_size % 4 * 50 + 50, ' FEET') WHEN 1 THEN concat(p_size % 3 * 50 + 50, ' FT = 1 INCH')
  WHEN 2 THEN concat('SHEETS ', p_size % 3 * 50 + 50, ' feet to 1 inch') WHEN 3 THEN p_name ELSE concat('ALE: ', p_size % 4 * 50 + 50) END AS text FROM {part}"""


@query(r"""
WITH t AS (""" + _SCALES.replace("{part}", "part") + r"""),
m AS (SELECT *, upper(text) AS up FROM t),
e AS (SELECT sheet, up, regexp_extract(up, '(?:SC)?ALE\W{0,4}([0-9]{2,4})\b', 1) AS a,
  regexp_extract(up, '\b([0-9]{2,4})\s*(?:FT|FEET)\b\W{0,6}(?:=|TO|-)?\s*(?:1|ONE|I|L)*\s*I?N?CH', 1) AS b FROM m),
s AS (SELECT sheet, CASE WHEN a <> '' THEN 0 WHEN b <> '' AND up LIKE '%SHEET%' THEN 2 WHEN b <> '' THEN 1 END AS rank, TRY_CAST(CASE WHEN a <> '' THEN a ELSE b END AS INTEGER) AS feet FROM e),
c AS (SELECT sheet, rank, feet, count(*) AS n FROM s WHERE rank IS NOT NULL GROUP BY ALL)
SELECT sheet, rank, feet FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY rank, n DESC, feet) AS rn FROM c) WHERE rn = 1
""")
def stated_scale(spark, d):
    return names.stated_scale(spark.sql(_SCALES, part=table(spark, d, "part")))


_SKIP = rf"""CASE WHEN in_block THEN 'in_block' WHEN NOT regexp_matches({fold_sql('text')}, '[A-Za-z]{{3,}}') OR name = '' THEN 'no_letters'
  WHEN typ IS NULL AND len(list_filter(string_split(name, ' '), lambda x: {_TYPES}[x] IS NULL AND x NOT IN ({_listed(D.DIRECTIONS)}))) = 0 THEN 'type_only'
  WHEN typ IS NULL AND len(list_filter(string_split(name, ' '), lambda x: x IN ({_listed(D.FURNITURE)}))) > 0 THEN 'furniture'
  WHEN regexp_matches(upper({fold_sql('text')}), '&|\b(CO|LTD|INC|BROS|SONS|MFG)\b\.?') OR len(string_split(name, ' ')) > 3 THEN 'business'
  WHEN len(replace(name, ' ', '')) < 4 THEN 'short' WHEN typ IS NULL AND regexp_matches(text, '[0-9]') THEN 'digits' END"""


@query(f"WITH {_T}, {norm_sql('t')} SELECT coalesce({_SKIP}, 'used') AS reason, count(*) AS n FROM n GROUP BY 1")
def name_skips(spark, d):
    reason = F.coalesce(names.skip_reason(F.col("text"), F.col("in_block")), F.lit("used"))
    return tokens(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"""
WITH {_T}, {norm_sql('t')},
u AS (SELECT *, regexp_replace({fold_sql('text')}, '[^A-Za-z]', '', 'g') AS letters FROM n WHERE {_SKIP} IS NULL),
g AS (SELECT sheet, name, count(*) AS occurrences, avg(CASE WHEN letters <> '' AND letters = upper(letters) THEN 1 ELSE 0 END) AS upper_frac,
  arg_min(typ, tok_id) FILTER (typ IS NOT NULL) AS typ FROM u GROUP BY sheet, name),
r AS (SELECT *, CASE WHEN typ IS NOT NULL THEN 'A' WHEN occurrences >= 2 OR (upper_frac = 1 AND len(name) >= 6) THEN 'B' ELSE 'C' END AS tier,
  round((CASE WHEN typ IS NOT NULL THEN 3 ELSE 0 END) + 2 * upper_frac + least(occurrences - 1, 3) + len(name) / 4.0e0, 2) AS rank FROM g)
SELECT sheet, name, typ, tier, occurrences, rank, row_number() OVER (PARTITION BY sheet ORDER BY rank DESC, name) > 25 AS over_max FROM r WHERE tier <> 'C'
""")
def name_groups(spark, d):
    return names.name_groups(tokens(spark, d)).select("sheet", "name", "typ", "tier", "occurrences", "rank", "over_max")


@query(f"""
WITH {_T}, {norm_sql('t')},
c AS (SELECT sheet, coalesce(typ, {_TYPES}[name]) AS typ, count(*) AS n, min(tok_id) AS first FROM n WHERE coalesce(typ, {_TYPES}[name]) IS NOT NULL GROUP BY ALL)
SELECT sheet, typ, n FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY n DESC, first) AS rn FROM c) WHERE rn = 1
""")
def dominant_type(spark, d):
    return names.dominant_type(tokens(spark, d))


@query("SELECT page_id, sha256(html) AS digest, len(html) AS chars FROM pages")
def content_hash(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"), F.length("html").cast("long").alias("chars"))


_LABELS = """SELECT label_id, sheet, concat(CASE label_id % 5 WHEN 0 THEN 'Am ' WHEN 1 THEN '' ELSE '' END, text, CASE label_id % 3 WHEN 0 THEN ' ST' WHEN 1 THEN '' ELSE ' Avenue' END) AS text, px, py, dir_deg FROM v_labels"""


def labels(spark, d):
    return spark.sql(_LABELS.replace("v_labels", "{v}"), v=view(spark, d, "v_labels"))


_MATCH = f"""
l AS (SELECT DISTINCT text FROM ({_LABELS})), {norm_sql('l')},
a AS (SELECT text, typ, {spell_sql('name')} AS key, {spell_sql(bare_sql('name'))} AS bare FROM n
  WHERE len(name) >= 3 AND NOT (typ IS NULL AND ({_TYPES}[name] IS NOT NULL OR name IN ({_listed(D.DIRECTIONS)})))),
s AS (SELECT DISTINCT street, {base_sql('street')} AS base FROM v_segments),
h AS (SELECT text, typ, street, 0 AS step FROM a JOIN s ON key = {spell_sql('base')} OR key = {spell_sql(turned_sql('base'))}
  UNION SELECT text, typ, street, 1 FROM a JOIN s ON bare = {spell_sql(bare_sql('base'))} AND len(bare) >= 3),
b AS (SELECT text, typ, street FROM (SELECT *, min(step) OVER (PARTITION BY text) AS best FROM h) WHERE step = best),
m AS (SELECT DISTINCT text, street FROM (SELECT *, bool_or(coalesce(street LIKE '% ' || typ, false)) OVER (PARTITION BY text) AS any_typed FROM b) WHERE NOT any_typed OR street LIKE '% ' || typ)"""


@query(f"WITH {_MATCH} SELECT text, street FROM m")
def street_match(spark, d):
    return names.match_streets(labels(spark, d), view(spark, d, "v_segments"))


_ALIASES = "SELECT upper(trim(text)) AS label, CASE WHEN min(label_id) % 2 = 0 THEN ['NO SUCH ST', (SELECT min(street) FROM v_segments)] ELSE ['NO SUCH ST'] END AS streets FROM ({l}) GROUP BY 1 HAVING min(label_id) % 3 = 0"


@query(f"""
WITH {_MATCH}, al AS ({_ALIASES.format(l=_LABELS)}), u AS (SELECT n.text, upper(trim(n.text)) AS label FROM n JOIN a USING (text)),
o AS (SELECT u.text, al.streets FROM u JOIN al USING (label))
SELECT text, street FROM m WHERE text NOT IN (SELECT text FROM o)
UNION ALL SELECT text, street FROM (SELECT text, unnest(streets) AS street FROM o) WHERE street IN (SELECT street FROM v_segments)
""")
def alias_match(spark, d):
    """Every third label is renamed to a street of the layer or silenced by a list without one."""
    layer, texts = view(spark, d, "v_segments"), labels(spark, d)
    first = F.array(F.lit("NO SUCH ST"), F.lit(layer.agg(F.min("street")).first()[0]))
    named = texts.groupBy(F.upper(F.trim("text")).alias("label")).agg(F.min("label_id").alias("i")).where("i % 3 = 0")
    aliases = named.select("label", F.when(F.col("i") % 2 == 0, first).otherwise(F.array(F.lit("NO SUCH ST"))).alias("streets"))
    return names.match_streets(texts, layer, aliases)


_SLIPS = """SELECT DISTINCT concat(substring(text, 1, 2), CASE length(text) % 3 WHEN 0 THEN '' WHEN 1 THEN substring(text, 3, 1) ELSE 'X' END, substring(text, 4)) AS text FROM v_labels"""


@query(f"""
WITH l AS ({_SLIPS}), {norm_sql('l')},
a AS (SELECT text, {spell_sql('name')} AS key FROM n WHERE len(name) >= 5 AND {_TYPES}[name] IS NULL),
p AS (SELECT {spell_sql('base')} AS pool, min(base) AS base FROM (SELECT DISTINCT {base_sql('street')} AS base FROM v_segments) WHERE len(base) >= 5 GROUP BY 1),
m AS (SELECT text, base FROM a JOIN p ON key <> pool AND (((starts_with(pool, key) OR suffix(pool, key)) AND len(pool) - len(key) <= 2 AND len(pool) >= len(key))
  OR (len(key) >= 6 AND abs(len(pool) - len(key)) <= 2 AND levenshtein(key, pool) <= CASE WHEN least(len(key), len(pool)) >= 9 THEN 2 ELSE 1 END)))
SELECT text, min(base) AS taken_for FROM m GROUP BY text HAVING count(*) = 1
""")
def fuzzy_match(spark, d):
    slips = spark.sql(_SLIPS.replace("v_labels", "{v}"), v=view(spark, d, "v_labels"))
    return names.fuzzy_streets(slips, view(spark, d, "v_segments"))
