"""Secret scan in DataFrame functions only: fixed patterns plus character Markov models.

The patterns find assignments, access keys and long hex strings. Beside them, every long run of
key characters is scored by two first-order Markov models of characters, one of random strings
and one of ordinary identifiers, both counted from labelled samples; a run whose log-likelihood
ratio per transition reaches the threshold is a secret too. In other runs the stretches of parts
between '+', '/', '-' and '_' that reach it are. Spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, pick, table

#: The kinds in their order, their patterns, and the least length of what is judged.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so asking for the least length in the pattern keeps the same matches as dropping short ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
#: Runs that the Markov models judge.
RUN = r"[A-Za-z0-9+/_-]{16,}"
RUN_LEAST = 16
#: Names as these are no secrets, though they look random; the Markov models don't see them.
UUID = r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])"
#: What lies between the separators of a run.
PART = r"[A-Za-z0-9]+"
CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
#: Least mean log-likelihood ratio of a transition, in thousandths of a nat.
THRESHOLD = 350
#: A stretch of parts ends where what follows costs more than this, in thousandths of a nat.
DROP = 8000
#: Spans gathered at once; a text may have any number of them.
SPANS_A_BLOCK = 256
#: Characters behind the last span that are still kept at hand.
CHARS_BEHIND = 16_384
MARK = "[SECRET]"


def _draw(k: int, n) -> Column:
    """A number from 1 to n by a hash of the id and k."""
    return (F.pmod(F.xxhash64("id", F.lit(k)), n) + 1).cast("int")


def _of(words: str, k: int) -> Column:
    found = words.split()
    return F.element_at(F.array(*map(F.lit, found)), _draw(k, F.lit(len(found))))


def _random_samples(ids: DataFrame) -> DataFrame:
    """Digests in hex and base 64, and strings over four alphabets."""
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    written = F.when(F.col("id") % 2 == 0, F.lower(F.hex(digest))).otherwise(F.regexp_replace(F.base64(digest), "=", ""))
    lower, digits = string.ascii_lowercase, string.digits
    kinds = F.array(*map(F.lit, (lower + lower.upper() + digits, lower + digits, lower.upper() + digits, lower + lower.upper())))
    alphabet = F.element_at(kinds, (F.col("id") % 4 + 1).cast("int"))
    one = lambda k: F.substring(alphabet, (F.pmod(F.xxhash64("id", k, F.lit("random")), F.length(alphabet)) + 1).cast("int"), F.lit(1))
    drawn = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), one), "")
    return ids.select(F.explode(F.array(written, drawn)).alias("text"), F.lit(1).alias("label"))


def _ordinary_samples(ids: DataFrame) -> DataFrame:
    """Names of code, paths, prose words run together, numbers and dates; words of made-up syllables;
    and the names that Spark gives its functions and settings."""
    spark = ids.sparkSession
    words = """the and for with that this from have value index count total name user account order item price date time file path data table column row key list node tree left right start end first last next size length width
        height color message error result status state type class object method function string number buffer stream reader writer handler service client server request response config option default version module package import
        export update delete insert select create load store read write open close heit keit lich einen schaft ung mente ando cion tion ment eaux elle ation ness able ing ering ould"""
    a, b, c, d = (_of(words, k) for k in range(4))
    number = F.lpad(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10**16)).cast("string"), 16, "4")
    begins, middles, ends = "b c d f g h j k l m n p qu r s t v w x y z br cl dr fl gr pl pr sh st th tr ch ph ck nd nt rs ll ss", "a e i o u ai ea ee ie ou y io", "r n t s ng ction ment er"
    syllable = lambda k: F.concat(_of(begins, 20 + 2 * k), _of(middles, 21 + 2 * k))
    e, f, g = F.concat(syllable(0), syllable(1), _of(ends, 40)), F.concat(syllable(2), syllable(3)), F.concat(syllable(4), F.lit("s"))
    forms = [F.concat(a, b, c, d), F.concat_ws("_", a, b, c), F.concat(a, F.initcap(b), F.initcap(c)), F.concat_ws("-", a, b, c), F.concat_ws("/", a, b, c, d), F.upper(F.concat_ws("_", a, b, c)), number, F.concat(a, F.lit("_"), F.substring(number, 1, 4), F.lit("-"), F.substring(number, 5, 2)), F.concat(b, c, a), F.concat(F.initcap(a), b, d)]
    made = [F.concat(e, f, g), F.concat_ws("_", e, f, g), F.concat(e, F.initcap(f), F.initcap(g)), F.upper(F.concat_ws("_", e, f)), F.concat_ws("-", e, f, g), F.concat_ws("/", e, f, g, a)]
    pick_one = lambda some: F.element_at(F.array(*some), (F.col("id") % len(some) + 1).cast("int"))
    names = spark.sql("SET -v").select(F.explode(F.split("key", "[.]")).alias("text")).unionByName(spark.sql("SHOW FUNCTIONS").select(F.col("function").alias("text"))).where("text rlike '^[A-Za-z][A-Za-z0-9_]{3,}$'").distinct()
    return ids.select(F.explode(F.array(pick_one(forms), pick_one(made))).alias("text")).unionByName(names.select(F.explode(F.array(F.col("text"), F.col("text"), F.upper("text"))).alias("text"))).withColumn("label", F.lit(0))


def default_samples(spark: SparkSession, n: int = 6000) -> DataFrame:
    """Labelled samples (text, label) made by rule: 1 random strings, 0 ordinary identifiers."""
    ids = spark.range(n)
    return _random_samples(ids).unionByName(_ordinary_samples(ids))


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios of character transitions, in thousandths of a nat, row by row."""

    table: tuple[int, ...]
    threshold: int = THRESHOLD


def train(samples: DataFrame, threshold: int = THRESHOLD) -> MarkovModel:
    """Count the transitions of both classes. What reaches the driver is at most two counts for
    each pair of CHARACTERS, however many samples there are. Characters outside end a run."""
    n = len(CHARACTERS)
    runs = samples.where("text is not null and label in (0, 1)").select("label", F.explode(F.expr(f"regexp_extract_all(text, '[{CHARACTERS[:-1]}-]+', 0)")).alias("run"))
    pairs = runs.select("label", F.explode(F.expr("transform(sequence(1, greatest(length(run) - 1, 1)), i -> substring(run, i, 2))")).alias("pair")).where("length(pair) = 2")
    counts = [[1.0] * (n * n), [1.0] * (n * n)]
    for r in pairs.groupBy("label", "pair").count().collect():
        counts[r["label"]][CHARACTERS.index(r["pair"][0]) * n + CHARACTERS.index(r["pair"][1])] += r["count"]
    logs = [[math.log(x / sum(side[k - k % n : k - k % n + n])) for k, x in enumerate(side)] for side in counts]
    return MarkovModel(tuple(round(1000 * (b - a)) for a, b in zip(*logs, strict=True)), threshold)


#: Models of the default samples, by application and number: they don't depend on any input.
_TRAINED: dict[tuple[str, int], MarkovModel] = {}


def default_model(spark: SparkSession, n: int = 6000) -> MarkovModel:
    """The model of `default_samples`, trained once in an application."""
    key = (spark.sparkContext.applicationId, n)
    if key not in _TRAINED:
        _TRAINED[key] = train(default_samples(spark, n))
    return _TRAINED[key]


def tables(model: MarkovModel) -> tuple[str, str]:
    """SQL of the numbers of the first 128 characters among CHARACTERS, and of the ratios."""
    codes = [0] * 128
    for k, c in enumerate(CHARACTERS):
        codes[ord(c)] = k
    return f"array({','.join(map(str, codes))})", f"array({','.join(map(str, model.table))})"


def total(run: str, code: str, ratios: str) -> str:
    """SQL of the sum of the ratios of a run of CHARACTERS, given as SQL, as the tables are."""
    n = len(CHARACTERS)
    chars = f"transform(split({run}, ''), c -> {code}[ascii(c)])"
    return f"aggregate({chars}, named_struct('last', -1, 'sum', 0L), (a, k) -> named_struct('last', k, 'sum', a.sum + if(a.last < 0, 0, {ratios}[greatest(a.last, 0) * {n} + k])), a -> a.sum)"


def ratio(run: str, model: MarkovModel) -> str:
    """SQL of the mean ratio of a run of CHARACTERS, given as SQL."""
    return f"({total(run, *tables(model))} / (length({run}) - 1))"


_SPAN = "struct<start:int,end:int>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def stretches(run: str, model: MarkovModel) -> str:
    """SQL of the spans (start, end) within a run, given as SQL, of the stretches of its parts that have
    RUN_LEAST characters and reach the threshold.

    Beyond the threshold a stretch gains what its transitions score above it. It opens with a part
    that gains, ends with the part up to which it gained most, and is closed where the gain is used
    up or DROP below the most. A part that is a secret alone is never left out."""
    code, ratios = tables(model)  # once in the plan, they are long
    over = lambda text, transitions: f"({total(text, 'y.code', 'y.ratios')} - {model.threshold}L * ({transitions}))"
    # of each part: what lies before it, its length, its gain, and the gain of the way to it from the part before
    way = "concat(right(y.parts[i - 1], 1), y.gaps[i], left(p, 1))"
    parts = f"""transform(array(named_struct('parts', regexp_extract_all({run}, '{PART}', 0), 'gaps', split({run}, '{PART}', -1), 'code', {code}, 'ratios', {ratios})), y ->
      transform(y.parts, (p, i) -> named_struct('gap', length(y.gaps[i]), 'n', length(p), 'own', {over('p', 'length(p) - 1')},
                                                'way', if(i = 0, 0L, {over(way, "length(y.gaps[i]) + 1")}))))[0]"""
    begin = "b.at + w.gap"
    end = f"{begin} + w.n"
    go_on = f"b.gain >= 0 and b.gain + w.way >= 0 and b.gain + w.way + w.own >= 0 and b.gain + w.way + {DROP} >= b.most"
    better = f"(b.gain + w.way + w.own >= b.most or (w.n >= {RUN_LEAST} and w.own >= 0))"
    ready = f"if(b.most >= 0 and b.end - b.start >= {RUN_LEAST}, array(named_struct('start', b.start, 'end', b.end)), {_NONE})"
    full = f"size(b.block) >= {SPANS_A_BLOCK}"
    # a part that uses up the gain of what came before begins anew
    on = f"named_struct('at', {end}, 'gain', b.gain + w.way + w.own, 'most', if({better}, b.gain + w.way + w.own, b.most), 'start', b.start, 'end', if({better}, {end}, b.end), 'block', b.block, 'out', b.out)"
    anew = f"named_struct('at', {end}, 'gain', w.own, 'most', w.own, 'start', {begin}, 'end', {end}, 'block', if({full}, {ready}, concat(b.block, {ready})), 'out', if({full}, concat(b.out, array(b.block)), b.out))"
    first = f"named_struct('at', 0, 'gain', -1L, 'most', -1L, 'start', 0, 'end', 0, 'block', {_NONE}, 'out', cast(array() as array<array<{_SPAN}>>))"
    return f"aggregate({parts}, {first}, (b, w) -> if({go_on}, {on}, {anew}), b -> flatten(concat(b.out, array(concat(b.block, {ready})))))"


def _whole(ok: str) -> str:
    """SQL of the spans within a match that is a span itself where `ok`, SQL too, holds."""
    return f"if({ok}, array(named_struct('start', 0, 'end', length(x.m))), {_NONE})"


def _found(kind: str, pattern: str, within: str, text: str = "text") -> Column:
    """Spans of one kind: lengths of what lies between matches and of the matches, added up. `within`
    is SQL of the spans within a match, `text` the column to look in."""
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    here = f"filter(zip_with(split({text}, '{p}', -1), regexp_extract_all({text}, '{p}', 0), (gap, m) -> named_struct('gap', length(gap), 'm', m)), x -> x.m is not null)"
    kind_of = "array<struct<start:int,end:int,rank:int>>"
    kept = f"transform({within}, s -> named_struct('start', a.at + x.gap + s.start, 'end', a.at + x.gap + s.end, 'rank', {KINDS.index(kind)}))"
    # in blocks: appending to one long array would copy it for every span
    full = f"size(a.block) >= {SPANS_A_BLOCK}"
    step = f"named_struct('at', a.at + x.gap + length(x.m), 'block', concat(if({full}, cast(array() as {kind_of}), a.block), {kept}), 'out', if({full}, concat(a.out, array(a.block)), a.out))"
    spans = f"aggregate({here}, named_struct('at', 0, 'block', cast(array() as {kind_of}), 'out', cast(array() as array<{kind_of}>)), (a, x) -> {step}, a -> flatten(concat(a.out, array(a.block))))"
    # most texts have none: one look tells, and only the others are taken apart
    return F.expr(f"if({text} rlike '{p}', {spans}, cast(array() as {kind_of}))")


def scan(df: DataFrame, model: MarkovModel, text_col: str = "text", out_col: str = "secret_spans") -> DataFrame:
    """All columns plus `out_col`: array of (start, end, kind), by start and then the kinds' order.

    Null and empty texts have no spans. A column that already has the name `out_col` is replaced.
    """
    if out_col in df.columns:
        df = df.drop(out_col)
    assign = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    found = [
        _found("assign", ASSIGN, _whole(f"length(regexp_extract(x.m, '{assign}', 2)) >= {ASSIGN_LEAST}")),
        _found("access", ACCESS, _whole("true")),
        _found("hex", HEX, _whole("true")),
        _found("markov", RUN, f"if({ratio('x.m', model)} >= {model.threshold}, {_whole('true')}, if(x.m rlike '[+/_-]', {stretches('x.m', model)}, {_NONE}))", "masked"),
    ]
    names = ",".join(f"'{k}'" for k in KINDS)
    packed = df.select(F.struct("*").alias("own"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    packed = packed.withColumn("masked", F.regexp_replace("text", UUID, " " * 36))  # of the same length
    spans = packed.select("own", *[f.alias(k) for f, k in zip(found, KINDS, strict=True)])
    # of all kinds, by start, then rank, then end
    ordered = F.expr(f"transform(array_sort(transform(concat({', '.join(KINDS)}), s -> named_struct('start', s.start, 'rank', s.rank, 'end', s.end))), s -> named_struct('start', s.start, 'end', s.end, 'kind', array({names})[s.rank]))")
    return spans.select("own.*", ordered.alias(out_col))


def redact(df: DataFrame, spans_col: str = "secret_spans", text_col: str = "text", mark: str = MARK) -> DataFrame:
    """Replace every stretch covered by spans with one mark. Texts without spans stay as they are."""
    t, s = f"`{text_col}`", f"`{spans_col}`"
    # a piece is looked up in what is left of the text, which is cut off now and then, so no piece
    # is sought from the text's beginning
    far, full = f"a.at - a.off >= {CHARS_BEHIND}", f"size(a.block) >= {SPANS_A_BLOCK}"
    opens = "x.start >= a.at and (x.start > a.at or a.at = 0)"
    new = f"if({opens}, array(substring(a.rest, a.at - a.off + 1, x.start - a.at), '{mark}'), cast(array() as array<string>))"
    cut = f"""aggregate({s}, named_struct('at', 0, 'off', 0, 'rest', {t}, 'block', cast(array() as array<string>), 'out', cast(array() as array<array<string>>)),
      (a, x) -> named_struct('at', greatest(a.at, x.end),
                             'off', if({far}, a.at, a.off), 'rest', if({far}, substring(a.rest, a.at - a.off + 1), a.rest),
                             'block', if({full}, {new}, concat(a.block, {new})), 'out', if({full}, concat(a.out, array(a.block)), a.out)),
      a -> concat(array_join(flatten(concat(a.out, array(a.block))), ''), substring(a.rest, a.at - a.off + 1)))"""
    return df.withColumn(text_col, F.expr(f"if({t} is null or size({s}) = 0, {t}, {cut})"))


def digests(df: DataFrame, model: MarkovModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov) for every row."""
    joined = lambda cond: f"concat_ws(',', transform(filter(spans, s -> {cond}), s -> concat_ws(':', s.kind, s.start, s.end)))"
    count = lambda kind: F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
    rows = scan(pick(df, doc_id=id_col, text=text_col), model, "text", "spans")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), count("assign"), count("access"), count("hex"), F.expr(f"sha2({joined("s.kind != 'markov'")}, 256)").alias("base_sha256"), F.expr(joined("true")).alias("spans"), count("markov"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_model(spark))
