"""Personal data by patterns and by what terms reveal, in DataFrame operations only.

Base spans: e-mail addresses, IPv4 addresses, card numbers (Luhn), telephone
numbers.  Patterns are written so that matching is linear in the text: a match
begins at the start of a run of characters (or where the last match ended) and
runs never give characters back.

Information-theoretic part, over the whole corpus.  M counts distinct texts, so
exact copies of one text prove nothing more; so do all counts n below.

* Protected entities.  Beside the base values these are secrets (keys, tokens,
  identifiers: runs of ``SECRET_CHARS`` characters or more that change between
  digits and letters all along and whose characters carry ``SECRET_BITS`` bits
  or more) and numbers (12 digits or more in a row, or four groups of four, that
  are no card).  The corpus decides: a value c says who or what is meant only if
  it has information, IC(c) = log2(M / n(c)) >= ``INFORMATION`` * log2(M); one that
  stands in too many different texts (a serial number of a notice) stays.
* Terms.  A term t (a whole run of letters outside e-mail addresses, lower case)
  that occurs within ``CONTEXT`` characters of an entity c is tested:

      PMI(c; t) = log2(M * n(c, t) / (n(c) * (n(t) + UNSEEN)))

  with one more text assumed to hold t without c, whatever the counts, so that
  a rare term is trusted less than a frequent one.  t discloses c if
  PMI(c; t) >= GENERALISE * IC(c): knowing t gives away that share of c's
  information.  Such terms become spans of kind "term" wherever they occur; from
  REMOVE * IC(c) on they are removed from the text, below it they are generalised
  to a placeholder.  A term of one text only has a share of 1 - 1 / log2(M).

Terms are counted by one row a distinct text: its copies are left out by a flag
(``_first_of_each``), not by counting distinct hashes, so a task sends a row a
term.  Tables are broadcast only if their bytes are counted and few.

Defined cases: a null text counts as the empty text and has no spans; a null
id is an id like any other; rows alike in id and text are one document and
come out alike; a table without rows gives no rows; other columns are passed
through unread; a document's terms are placed in time linear in its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import few_bytes, stash, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term", "secret", "number")
TERM, SECRET_KIND, NUMBER_KIND = 4, 5, 6
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
PATTERNS = {0: EMAIL, 1: IP, 2: CARD, 3: PHONE, SECRET_KIND: SECRET}

CONTEXT = 64            # characters on either side of a value
UNSEEN = 1              # texts that are assumed to hold a term without the value
GENERALISE, REMOVE = 0.9, 0.99   # shares of the value's information content
MIN_LETTERS = 3         # of a term
SECRET_CHARS, SECRET_BITS = 16, 48
NUMBER = r"[0-9]{12}|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"
INFORMATION = 0.25      # share of log2(M) that a secret or a number has at least
SURELY = 3              # distinct texts up to which a value has information in a table of any size
NOT_LETTER = r"[^\p{L}]"


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))


def _matches(kind: int, pattern: Column) -> Column:
    """Matches in ``text``, each with the number of characters between it and the one before."""
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    gaps = F.split("text", pattern, -1)
    listed = F.zip_with(hits, gaps, lambda h, g: F.struct(F.lit(kind).alias("kind"), F.length(g).alias("gap"), h.alias("hit")))
    found = F.filter(listed, lambda x: x["hit"].isNotNull())      # no match follows the last gap
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast("array<struct<kind:int,gap:int,hit:string>>"))


def _hits(kind: int) -> Column:
    may = F.col("text").contains("@") if kind == 0 else F.col("text").rlike("[0-9]")
    return F.when(may, _matches(kind, F.lit(PATTERNS[kind])))


def _placed(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, kind, gap, hit) with start and end: code points, end exclusive."""
    before = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    alike = found.repartition("doc_id", "text_hash").dropDuplicates(["doc_id", "text_hash", "kind", "n"])     # of rows alike
    return (alike.withColumn("end", F.sum(F.col("gap").cast("long") + F.length("hit")).over(before))
            .withColumn("start", F.col("end") - F.length("hit")))


def _digits(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    one = lambda d: d.try_cast("int")
    worth = F.transform(back, lambda d, i: F.when(i % 2 == 0, one(d)).otherwise(F.when(one(d) > 4, one(d) * 2 - 9).otherwise(one(d) * 2)))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _secret(hit: Column) -> Column:
    """Whether a run looks drawn at random: it changes between digits and others all along, and its characters carry many bits."""
    n = F.length(hit)
    changes = F.length(F.regexp_replace(hit, "[0-9]++|[^0-9]++", "x")) - 1
    shares = F.transform(F.array_distinct(F.split(hit, "")), lambda c: (n - F.length(F.replace(hit, c))) / n)
    bits = -F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0)) * n
    return (changes >= F.greatest(F.lit(3), n / 8)) & F.when(changes >= 3, bits >= SECRET_BITS).otherwise(False)


def _settled(placed: DataFrame) -> DataFrame:
    """Matches that hold, and what kind they are: long numbers that are no cards are of their own kind."""
    hit, kind = F.col("hit"), F.col("kind")
    part_ok = F.forall(F.split(hit, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                       & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    digits = F.length("digits")
    card = digits.between(13, 19) & F.when(digits.between(13, 19), _luhn(F.col("digits"))).otherwise(False)
    settled = (F.when(kind == 0, kind).when((kind == 1) & part_ok, kind).when((kind == 2) & card, kind)
               .when((kind == 2) & hit.rlike(NUMBER), NUMBER_KIND).when((kind == 3) & digits.between(9, 15), kind)
               .when((kind == SECRET_KIND) & _secret(hit), kind))
    return (placed.withColumn("digits", F.when(kind.isin(2, 3), _digits(hit))).withColumn("kind", settled)
            .where(F.col("kind").isNotNull()))


def value_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, value) of every protected entity; code points, end exclusive.

    Secrets and numbers that overlap a base span are left to it.
    """
    found = (texts.select("doc_id", "text_hash", F.array(*[_hits(k) for k in PATTERNS]).alias("hits"))
             .select("doc_id", "text_hash", F.explode("hits").alias("hits"))
             .select("doc_id", "text_hash", F.posexplode("hits").alias("n", "h"))
             .select("doc_id", "text_hash", "n", "h.*"))
    kind = F.col("kind")
    value = F.when(kind == 0, F.lower("hit")).when(kind.isin(1, SECRET_KIND), F.col("hit")).otherwise(F.col("digits"))
    spans = stash(_settled(_placed(found)).select("doc_id", "text_hash", "kind", "start", "end", value.alias("value")), "value-spans")
    base = spans.where(kind < TERM)
    return base.unionByName(_outside(spans.where(kind > TERM), base))


def _outside(spans: DataFrame, others: DataFrame) -> DataFrame:
    """Those of ``spans`` that overlap none of ``others``."""
    held = others.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    return spans.join(held, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
                      & (F.col("start") < F.col("_end")) & (F.col("_start") < F.col("end")), "left_anti")


def _first_of_each(texts: DataFrame) -> tuple[DataFrame, int]:
    """A row for each distinct text of which there are several rows (hash, the smallest id, rows with that id), and
    the number of distinct texts."""
    rows = texts.groupBy("text_hash", "doc_id").agg(F.count("*").alias("alike"))
    one = rows.groupBy("text_hash").agg(F.min(F.struct("doc_id", "alike")).alias("one"), F.sum("alike").alias("copies"))
    listed = stash(one.select("text_hash", "one.*", "copies"), "distinct-texts")
    return listed.where("copies > 1").select(F.col("text_hash").alias("_hash"), F.col("doc_id").alias("_id"), "alike"), listed.count()


def _once(rows: DataFrame, several: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_hash and more) of the first of each distinct text, with ``weight``: one over the rows alike."""
    held = few_bytes(several, F.lit(40))
    return (rows.join(held, F.col("text_hash") == F.col("_hash"), "left")
            .where(F.col("_hash").isNull() | F.col("doc_id").eqNullSafe(F.col("_id")))
            .withColumn("weight", F.when(F.col("alike") > 1, 1.0 / F.col("alike")).otherwise(1.0)).drop("_hash", "_id", "alike"))


def _terms(text: Column) -> Column:
    """Distinct lower-case runs of letters, without those inside e-mail addresses."""
    return _runs(F.when(text.contains("@"), F.regexp_replace(text, EMAIL, " ")).otherwise(text))


def _runs(text: Column) -> Column:
    runs = F.split(F.lower(text), NOT_LETTER + "+")
    return F.filter(F.array_distinct(runs), lambda w: F.length(w) >= MIN_LETTERS)


def _blanked(text: Column) -> Column:
    """The text with a space for each character of its e-mail addresses."""
    blanks = F.zip_with(F.split(text, EMAIL, -1), F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)),
                        lambda gap, hit: F.concat(gap, F.coalesce(F.repeat(F.lit(" "), F.length(hit)), F.lit(""))))
    return F.when(text.contains("@"), F.array_join(blanks, "")).otherwise(text)


def informative(spans: DataFrame, several: DataFrame, n_texts: int) -> DataFrame:
    """(kind, value, n_c): protected values and the distinct texts that hold them, without secrets and numbers of too many texts."""
    held = spans.select("doc_id", "text_hash", "kind", "value").distinct()
    counts = _once(held, several).groupBy("kind", "value").agg(F.count("*").cast("double").alias("n_c"))    # rows alike are one here
    most = max(SURELY, n_texts ** (1 - INFORMATION))
    return stash(counts.where((F.col("kind") < TERM) | (F.col("n_c") <= most)), "values")


def disclosing_terms(texts: DataFrame, spans: DataFrame, values: DataFrame, several: DataFrame, n_texts: int) -> tuple[DataFrame, DataFrame]:
    """(term, share): terms that give away a protected value, and the largest share of its information they give away;
    and (doc_id, text_hash, term): where the terms that were tested occur."""
    own = spans.select("doc_id", "text_hash", "kind", "value", "start", "end")
    places = stash(_once(own, several).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                   .agg(F.collect_list(F.struct("kind", "value", "start", "end")).alias("places")), "value-places")
    size = F.aggregate("places", F.lit(40).cast("long"), lambda a, p: a + 40 + F.octet_length(p["value"]))
    near = (texts.where(F.col("text").rlike("[0-9@]"))
            .join(few_bytes(places, size), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
            .select("text_hash", _blanked(F.col("text")).alias("blanked"), F.explode("places").alias("p"))
            .select("text_hash", "p.kind", "p.value",
                    F.explode(_runs(_around(F.col("p.start"), F.col("p.end")))).alias("term")).distinct())
    near = stash(near, "near-terms")                       # a row for each distinct text, value and term
    joint = near.groupBy("kind", "value", "term").agg(F.count("*").alias("n_ct"))
    seen = near.select("term", "text_hash").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    of_all, of_c, of_ct = F.lit(float(n_texts)), F.col("n_c"), F.col("n_ct")
    # a term close to values in so many texts that it discloses none of them need not be counted: n_near <= n_t,
    # as every run that counts as near is a run of its whole text, too
    most = of_ct * F.pow(of_all / of_c, F.lit(1 - GENERALISE)) * (1 + 1e-9)
    candidates = stash(joint.join(values, ["kind", "value"]).join(seen, "term")
                       .where(F.col("n_near") + UNSEEN <= most).drop("n_near"), "candidate-terms")
    # the documents with each candidate term, over the whole corpus: read once, for the counts and for the places
    wanted = few_bytes(candidates.select("term").distinct(), 40 + F.octet_length("term"))
    occur = stash(texts.select("doc_id", "text_hash", F.explode(_terms(F.col("text"))).alias("term")).join(wanted, "term"), "term-places")
    counts = _once(occur, several).groupBy("term").agg(F.round(F.sum("weight")).alias("n_t"))
    pmi = F.log2(of_all * of_ct / (of_c * (F.greatest("n_t", "n_ct") + UNSEEN)))
    content = F.log2(of_all / of_c)
    terms = (candidates.join(counts, "term").where(of_c < of_all)
             .groupBy("term").agg(F.max(pmi / content).alias("share")).where(F.col("share") >= GENERALISE))
    return stash(terms, "disclosing-terms"), occur


def _around(start: Column, end: Column) -> Column:
    """The characters of ``blanked`` close to a span, without the span itself and without runs of letters that go on outside."""
    first = F.greatest(start - CONTEXT - 1, F.lit(0))       # one more on either side tells whether a run goes on
    left = F.substring("blanked", first.cast("int") + 1, (start - first).cast("int"))
    right = F.substring("blanked", end.cast("int") + 1, F.lit(CONTEXT + 1))
    return F.concat(F.when(start > CONTEXT, F.regexp_replace(left, r"^\p{L}++", "")).otherwise(left), F.lit(" "),
                    F.when(F.length(right) > CONTEXT, F.regexp_replace(right, r"(?<!\p{L})\p{L}++\z", "")).otherwise(right))


def _shown(words: Column) -> Column:
    """The text with a mark (U+0000) for every character outside those of its runs of letters that are among ``words``."""
    hidden = lambda x: F.repeat(F.lit("\0"), F.length(x))
    gaps, runs = F.split("text", r"\p{L}+", -1), F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    seen = F.zip_with(gaps, runs, lambda gap, run: F.concat(
        hidden(gap), F.when(run.isNull(), "").when(F.array_contains(words, F.lower(run)), run).otherwise(hidden(run))))
    return F.array_join(seen, "")


def term_spans(texts: DataFrame, terms: DataFrame, occur: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, share) of every occurrence of ``terms`` outside ``spans``."""
    few = few_bytes(terms.select("term", "share"), 40 + F.octet_length("term"))
    own = stash(occur.join(few, "term").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
                .agg(F.collect_set("term").alias("terms")), "texts-with-terms")
    size = F.aggregate("terms", F.lit(40).cast("long"), lambda a, t: a + 16 + F.octet_length(t))
    some = texts.join(few_bytes(own, size), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    shown = some.select("doc_id", "text_hash", _shown(F.col("terms")).alias("text"))
    runs = (shown.select("doc_id", "text_hash", F.posexplode(_matches(TERM, F.lit(r"[^\x00]++"))).alias("n", "h"))
            .select("doc_id", "text_hash", "n", "h.*"))
    placed = _placed(runs).withColumn("term", F.lower("hit")).join(few, "term")
    return _outside(placed, spans).select("doc_id", "text_hash", F.lit(TERM).alias("kind"), "start", "end", "share")


def all_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, spans): per document with any span, its spans (kind, start, end, share) in order."""
    texts = _texts(docs, key, text)
    several, n_texts = _first_of_each(texts)
    spans = stash(value_spans(texts), "entity-spans")
    values = informative(spans, several, n_texts)
    told = few_bytes(values.where(F.col("kind") > TERM).select("kind", "value"), 40 + F.octet_length("value"))
    spans = spans.where(F.col("kind") < TERM).unionByName(spans.where(F.col("kind") > TERM).join(told, ["kind", "value"], "left_semi"))
    spans = stash(spans, "protected-spans")
    terms, occur = disclosing_terms(texts, spans, values, several, n_texts)
    found = spans.select("doc_id", "text_hash", "kind", "start", "end", F.lit(None).cast("double").alias("share")).unionByName(
        term_spans(texts, terms, occur, spans))
    listed = found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "share"))).alias("spans"))
    return stash(listed, "spans")


def _with_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    spans = all_spans(docs, key, text).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("_key"), text_or_empty(text).alias("_text"))
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,share:double>>")
    return (rows.join(few_bytes(spans, 40 + 32 * F.size("spans")), F.col("_key").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_hash")), "left")
            .withColumn("spans", F.coalesce("spans", empty)))


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, n_secret, n_number, n_spans (all), base_sha256, spans of every row."""
    names = F.array(*[F.lit(k) for k in KINDS])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < TERM)
    return _with_spans(docs, key, text).select(
        F.col("_key").alias("doc_id"), *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.size("spans").cast("long").alias("n_spans"), F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``clean``: base values and generalised terms are placeholders, removed terms are gone."""
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["share"].alias("share"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        mark = F.when((s["kind"] == TERM) & (s["share"] >= REMOVE), F.lit("")).otherwise(F.get(marks, s["kind"]))
        gap = F.substring(F.col("_text"), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        # of spans that overlap, the first is marked and the rest of the others goes with it
        return F.struct(F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, mark)).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))
    clean = F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substring(F.col("_text"), a["at"].cast("int") + 1, F.length("_text"))))
    return _with_spans(docs, key, text).select("row", F.when(F.size("spans") == 0, F.col("_text")).otherwise(clean).alias("clean"))
