"""SQL fragments (DuckDB dialect) equal to the Spark expressions in
``sparkclassify.functions``.  They are used to write the independent oracle
statements that check each query; nothing here runs on Spark.
"""

from __future__ import annotations

from ..functions.hashing import split_bounds
from ..functions.stopwords import sql_list
from .doc_features import CHAR_CLASSES, CHAR_PROBES, feature_names

WS_CLASS = r"[ \t\n\x0B\f\r]"
WS_CHARS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
JAVA_TRIM_RE = r"\A[\x00-\x20]+|[\x00-\x20]+\z"


def strip(x: str, keep_digits: bool = True) -> str:
    cls = r"[^A-Za-z0-9 \t\n\x0B\f\r]+" if keep_digits else r"[^A-Za-z \t\n\x0B\f\r]+"
    return f"regexp_replace({x}, '{cls}', '', 'g')"


def java_trim(x: str) -> str:
    return f"regexp_replace({x}, '{JAVA_TRIM_RE}', '', 'g')"


def clean(x: str, keep_digits: bool = True) -> str:
    # After the strip only the six whitespace characters can be <= U+0020.
    return f"lower(trim({strip(x, keep_digits)}, {WS_CHARS}))"


def tokens(x: str) -> str:
    low = f"lower({x})"
    stripped = f"regexp_replace({low}, '{WS_CLASS}+\\z', '')"
    return (f"CASE WHEN {low} <> '' AND {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({stripped}, '{WS_CLASS}') END")


def no_stop_words(x: str) -> str:
    return f"list_filter({x}, lambda t: lower(t) NOT IN ({sql_list()}))"


def md5_u32(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


def md5_bucket(x: str, n: int = 10000) -> str:
    return f"CAST({md5_u32(x)} % {n} AS INTEGER)"


def split_part(keys, weights, seed: int) -> str:
    args = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    h = md5_u32(f"concat_ws(':', {args})")
    bounds = split_bounds(weights)
    whens = " ".join(f"WHEN {h} < {b} THEN {i}" for i, b in enumerate(bounds))
    return f"CAST(CASE {whens} ELSE {len(bounds)} END AS INTEGER)"


def english_label(lang: str = "lang") -> str:
    return f"CASE WHEN {lang} = 'en' THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"


DOC_LINES = f"""doc_lines AS (
  SELECT d.doc_id, CAST(u.n - 1 AS INTEGER) AS line_no, {english_label('d.lang')} AS label, u.line
  FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS u(line, n))"""

CLEAN_LINES = DOC_LINES + f""",
clean_lines AS (
  SELECT doc_id, line_no, label, {clean('line')} AS clean FROM doc_lines)"""

LINE_TERMS = CLEAN_LINES + f""",
line_terms AS (
  SELECT doc_id, line_no, label, {no_stop_words(tokens('clean'))} AS terms FROM clean_lines)"""

DOC_TERMS = f"""doc_terms AS (
  SELECT doc_id, lang, {no_stop_words(tokens(clean('text')))} AS terms FROM documents)"""

def lang_index(where: str = "true") -> str:
    """Label index of ``lang`` fitted on the documents of ``where``."""
    return f"""lang_index AS (
  SELECT lang, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS label
  FROM documents WHERE {where} GROUP BY lang)"""


LANG_INDEX = lang_index()


def murmur3_buckets(terms: str, n: int = 10000, byte_tail: bool = False) -> str:
    """CTE ``term_bucket(term, bucket)`` of the distinct ASCII terms of the
    relation ``terms(term)``: 32-bit Murmur3, seed 42, over the bytes, then a
    positive modulus.  ``byte_tail`` mixes each byte after the last whole
    block as a block of its own (Spark SQL's ``hash``, the original runs);
    without it the tail is mixed the standard way (``HashingTF`` since 3.0)."""
    low = "4294967295::UBIGINT"

    def byte(i):
        return f"CAST(unicode(substr(term, CAST({i} AS BIGINT), 1)) AS UBIGINT)"

    def times(x, c):
        return f"(({x} * {c}::UBIGINT) & {low})"

    def turn(x, by):
        return f"((({x} << {by}) | ({x} >> {32 - by})) & {low})"

    def scramble(k):
        return times(turn(times(k, 0xCC9E2D51), 15), 0x1B873593)

    blocks = f"[{byte('4 * i + 1')} + 256 * {byte('4 * i + 2')} + 65536 * {byte('4 * i + 3')} + 16777216 * {byte('4 * i + 4')} FOR i IN range(n // 4)]"
    rest = f"[{byte('i')} FOR i IN range(4 * (n // 4) + 1, n + 1)]"
    tail = " + ".join(f"(CASE WHEN n % 4 > {i} THEN {byte(f'4 * (n // 4) + {i + 1}')} ELSE 0::UBIGINT END) * {256 ** i}" for i in range(3))
    step = f"(({turn('xor(h, ' + scramble('k') + ')', 13)} * 5::UBIGINT + 3864292196::UBIGINT) & {low})"
    return f"""mm0 AS (SELECT DISTINCT term, strlen(term) AS n FROM {terms} WHERE term IS NOT NULL),
mm1 AS (SELECT term, n, {f'list_concat({blocks}, {rest})' if byte_tail else blocks} AS parts,
  {'0::UBIGINT' if byte_tail else tail} AS tail FROM mm0),
mm2 AS (SELECT term, xor(xor(list_reduce(list_concat([42::UBIGINT], parts), lambda h, k: {step}),
  {scramble('tail')}), CAST(n AS UBIGINT)) AS h FROM mm1),
mm3 AS (SELECT term, {times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM mm2),
mm4 AS (SELECT term, {times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM mm3),
mm5 AS (SELECT term, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM mm4),
term_bucket AS (SELECT term, CAST((((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {n}) + {n}) % {n} AS INTEGER) AS bucket FROM mm5)"""


def unnest_outer(terms: str) -> str:
    """``explode_outer``: an empty list gives one null element."""
    return f"unnest(CASE WHEN len({terms}) = 0 THEN [NULL]::VARCHAR[] ELSE {terms} END)"


def nb_chain(src: str, keys: str, n: int = 10000, lam: float = 1.0, murmur: bool = False) -> str:
    """CTEs for the text naive Bayes pipeline over ``src`` (columns
    ``keys``, ``label``, ``terms``, ``part``; part 0 trains, 1 tests):
    TF (md5 buckets, or with ``murmur`` those of ``HashingTF``) -> IDF
    (train) -> TF-IDF -> L2 -> NB fit -> test scores.
    Defines ``nb_theta`` and ``nb_scored``."""
    b = "bucket" if murmur else md5_bucket("term", n)
    look = " LEFT JOIN term_bucket USING (term)" if murmur else ""
    before = (f"src_terms AS (SELECT unnest(terms) AS term FROM {src}),\n" + murmur3_buckets("src_terms", n) + ",\n"
              if murmur else "")
    part_keys = keys
    return before + f"""nb_train AS (SELECT * FROM {src} WHERE part = 0),
nb_test AS (SELECT * FROM {src} WHERE part = 1),
nb_m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM nb_train),
nb_tf AS (
  SELECT {keys}, label, CASE WHEN term IS NULL THEN NULL ELSE {b} END AS bucket,
    CAST(count(term) AS DOUBLE) AS tf
  FROM (SELECT {keys}, label, {unnest_outer('terms')} AS term FROM nb_train){look}
  GROUP BY ALL),
nb_idf AS (
  SELECT bucket, ln(((SELECT m FROM nb_m) + 1.0) / (count(*) + 1.0)) AS idf
  FROM nb_tf WHERE bucket IS NOT NULL GROUP BY bucket),
nb_w AS (
  SELECT {keys}, label, bucket,
    tf * coalesce(idf, ln((SELECT m FROM nb_m) + 1.0)) AS weight
  FROM nb_tf LEFT JOIN nb_idf USING (bucket)),
nb_n AS (
  SELECT {keys}, label, bucket,
    CASE WHEN sqrt(sum(weight * weight) OVER (PARTITION BY {part_keys})) > 0
         THEN weight / sqrt(sum(weight * weight) OVER (PARTITION BY {part_keys})) ELSE 0.0 END AS weight
  FROM nb_w),
nb_s AS (SELECT label, bucket, sum(weight) AS s FROM nb_n WHERE bucket IS NOT NULL GROUP BY label, bucket),
nb_cls AS (SELECT label, count(*) AS n_docs FROM nb_train GROUP BY label),
nb_tot AS (SELECT label, sum(s) AS s_total FROM nb_s GROUP BY label),
nb_c AS (
  SELECT label, n_docs,
    ln(n_docs + {lam}) - ln(sum(n_docs) OVER () + count(*) OVER () * {lam}) AS log_prior,
    ln(coalesce(s_total, 0.0) + {lam} * {n}) AS log_norm,
    ln({lam}) - ln(coalesce(s_total, 0.0) + {lam} * {n}) AS log_default
  FROM nb_cls LEFT JOIN nb_tot USING (label)),
nb_theta AS (
  SELECT nb_s.label, nb_s.bucket, ln(nb_s.s + {lam}) - nb_c.log_norm AS log_theta
  FROM nb_s JOIN nb_c USING (label)),
nb_ttf AS (
  SELECT {keys}, label, CASE WHEN term IS NULL THEN NULL ELSE {b} END AS bucket,
    CAST(count(term) AS DOUBLE) AS tf
  FROM (SELECT {keys}, label, {unnest_outer('terms')} AS term FROM nb_test){look}
  GROUP BY ALL),
nb_tw AS (
  SELECT {keys}, label, bucket,
    tf * coalesce(idf, ln((SELECT m FROM nb_m) + 1.0)) AS weight
  FROM nb_ttf LEFT JOIN nb_idf USING (bucket)),
nb_tn AS (
  SELECT {keys}, label, bucket,
    CASE WHEN sqrt(sum(weight * weight) OVER (PARTITION BY {part_keys})) > 0
         THEN weight / sqrt(sum(weight * weight) OVER (PARTITION BY {part_keys})) ELSE 0.0 END AS weight
  FROM nb_tw),
nb_sc AS (
  SELECT {', '.join('t.' + k.strip() for k in keys.split(','))}, t.label, c.label AS cls,
    c.log_prior + c.log_default * sum(t.weight)
      + sum(t.weight * coalesce(th.log_theta - c.log_default, 0.0)) AS score
  FROM nb_tn t CROSS JOIN nb_c c
  LEFT JOIN nb_theta th ON th.bucket = t.bucket AND th.label = c.label
  GROUP BY {', '.join('t.' + k.strip() for k in keys.split(','))}, t.label, c.label, c.log_prior, c.log_default),
nb_rank AS (
  SELECT *, row_number() OVER (PARTITION BY {part_keys} ORDER BY score DESC, cls) AS rk,
    max(score) OVER (PARTITION BY {part_keys}) AS mx FROM nb_sc),
nb_prob AS (
  SELECT *, 1.0 / sum(exp(score - mx)) OVER (PARTITION BY {part_keys}) AS probability FROM nb_rank),
nb_scored AS (
  SELECT {keys}, label, cls AS prediction, score, probability FROM nb_prob WHERE rk = 1)"""


def char_features(text: str) -> str:
    """List of the character statistics, in order of ``feature_names``."""
    n = f"greatest(length({text}), 1)::DOUBLE"
    quoted = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    out = [f"ln(1.0 + length({text}))"]
    out += [f"(length({text}) - length(translate({text}, {quoted(c)}, ''))) / {n}" for c in CHAR_CLASSES.values()]
    out.append(f"length(regexp_replace({text}, '[\\x00-\\x7F]+', '', 'g')) / {n}")
    out += [f"((length({text}) - length(replace({text}, {quoted(p)}, ''))) / {len(p)}.0::DOUBLE) / {n} * 1000.0"
            for p in CHAR_PROBES]
    return "[" + ", ".join(f"({x})::DOUBLE" for x in out) + "]"


def newton_chain(split, seed: int, most_steps: int = 16) -> str:
    """CTEs of the logistic fit on ``labels.quality``: Newton steps as a
    recursion whose rows are the coefficients; each builds the Hessian and the
    gradient from the training rows and solves them by elimination.  The first
    step, from zero, fits the logits of 3/4 and 1/4 (least squares), and the
    probabilities stay 1e-16 off 0 and 1, both as generalized linear models
    start and bound them.  Ends in ``lr_coef(i, feature, coefficient)`` and
    ``lr_scored(doc_id, part, label, raw_score, p, prediction)``."""
    d = len(feature_names())
    names = ", ".join(f"'{f}'" for f in feature_names())
    solve = f"""list_transform(list_reduce(
      [m] || list_transform(range(1, {d + 2}), lambda k: [[k::DOUBLE]]),
      lambda a, q: list_transform(a, lambda r, i: CASE WHEN i = q[1][1]::INTEGER
        THEN list_transform(r, lambda v: v / r[q[1][1]::INTEGER])
        ELSE list_transform(r, lambda v, j: v - r[q[1][1]::INTEGER] / a[q[1][1]::INTEGER][q[1][1]::INTEGER]
          * a[q[1][1]::INTEGER][j]) END)), lambda r: r[{d + 2}])"""
    return f"""RECURSIVE lr_all AS MATERIALIZED (
  SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS quality, {split_part(['doc_id'], split, seed)} AS part,
    {char_features('d.text')} AS x
  FROM documents d JOIN labels l USING (doc_id)),
lr_index AS (
  SELECT quality, CAST(row_number() OVER (ORDER BY count(*) DESC, quality) - 1 AS DOUBLE) AS label
  FROM lr_all WHERE part = 0 GROUP BY quality),
lr_data AS MATERIALIZED (SELECT doc_id, part, label, x FROM lr_all JOIN lr_index USING (quality)),
lr_moments AS MATERIALIZED (
  SELECT list(mean ORDER BY i) AS mean, list(spread ORDER BY i) AS spread FROM (
    SELECT i, avg(x[i]) AS mean, stddev_samp(x[i]) AS spread
    FROM lr_data, range(1, {d + 1}) AS t(i) WHERE part = 0 GROUP BY i)),
lr_train AS MATERIALIZED (
  SELECT label AS y, list_transform(x, lambda v, i: CASE WHEN spread[i] > 0 THEN (v - mean[i]) / spread[i] ELSE 0.0 END)
    || [1.0::DOUBLE] AS z FROM lr_data, lr_moments WHERE part = 0),
newton AS (
  SELECT 0 AS step, list_transform(range({d + 1}), lambda i: 0.0::DOUBLE) AS b
  UNION ALL
  SELECT step + 1, list_transform(list_zip(b, {solve}),
    lambda u: u[1] + u[2] * CASE WHEN step = 0 THEN ln(3.0) / 2 ELSE 1 END)
  FROM (
    SELECT step, b, list(r ORDER BY i) AS m FROM (
      SELECT step, b, i, list(s ORDER BY j) AS r FROM (
        SELECT step, b, i, j, sum(CASE WHEN j <= {d + 1} THEN p * (1 - p) * z[i] * z[j] ELSE (y - p) * z[i] END) AS s
        FROM (SELECT step, b, y, z,
                least(greatest(1 / (1 + exp(-list_dot_product(b, z))), 1e-16::DOUBLE), 1 - 1e-16::DOUBLE) AS p
              FROM newton, lr_train WHERE step <= {most_steps}),
          range(1, {d + 2}) AS u(i), range(1, {d + 3}) AS v(j)
        GROUP BY step, b, i, j) GROUP BY step, b, i) GROUP BY step, b)),
lr_beta AS MATERIALIZED (SELECT b FROM newton ORDER BY step DESC LIMIT 1),
lr_coef AS MATERIALIZED (
  SELECT i, [{names}][i] AS feature, CASE WHEN spread[i] > 0 THEN b[i] / spread[i] ELSE 0.0 END AS coefficient,
    b[i] / spread[i] * mean[i] AS shift FROM lr_beta, lr_moments, range(1, {d + 1}) AS t(i)),
lr_line AS (
  SELECT list(coefficient ORDER BY i) AS c, any_value((SELECT b[{d + 1}] FROM lr_beta)) - sum(shift) AS c0 FROM lr_coef),
lr_raw AS (SELECT doc_id, part, label, list_dot_product(c, x) + c0 AS raw_score FROM lr_data, lr_line),
lr_scored AS (
  SELECT doc_id, part, label, raw_score, 1 / (1 + exp(-raw_score)) AS p,
    CASE WHEN 1 / (1 + exp(-raw_score)) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM lr_raw)"""


def areas(score: str, src: str = "lr_scored WHERE part = 1") -> str:
    """``(auroc, aupr)`` of the ``score`` of ``src(label, score)``."""
    return f"""WITH counts AS (SELECT {score} AS s, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY 1),
  t AS (SELECT s, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg,
      sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM counts WINDOW w AS (ORDER BY s DESC)),
  c AS (SELECT *, tp - pos AS tp0, fp - neg AS fp0, tp / (tp + fp) AS pr,
      CASE WHEN tp + fp = pos + neg THEN tp / (tp + fp) ELSE (tp - pos) / (tp + fp - pos - neg) END AS pr0 FROM t)
  SELECT sum((fp - fp0) / n * (tp + tp0) / p / 2) AS auroc, sum((tp - tp0) / p * (pr + pr0) / 2) AS aupr FROM c"""
