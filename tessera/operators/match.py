"""Entity resolution against a master table.

The reference scores every (name, master) pair in a nested loop.  Here the
theta join becomes a blocked equi-join:

* a pair with no common word has Jaccard 0, so its combined score is at most
  0.4 (sequence part only) and its Jaccard score is 0;  candidates therefore
  come from an equi-join on exploded word tokens (plus, with a conference
  bonus, an equi-join on the conference, because a +0.15 pair may share no
  word);
* the shared-token count of a pair is the number of joined token rows, so the
  Jaccard value is exact without array intersection;
* the sequence ratio (Python) runs only on candidate pairs, once per distinct
  (left name, master name);
* left names are de-duplicated first and results joined back.

Exactness: with the Jaccard scorer the result equals the nested loop (a
zero-score pair never wins because the reference needs a strictly positive
score).  With the combined scorer a result row carries ``complete = true``
when its k-th best score is above 0.4 (+ nothing outside the blocks can beat
it); rows with ``complete = false`` may miss pairs that share no word and no
conference and score at most 0.4 on characters alone; they go to the review
queue of ``resolve_matches``.

Whether a side is broadcast is left to Spark's own sizes; AQE's skew-join
split handles hot tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import BONUS, JAC_WEIGHT, SEQ_WEIGHT, round_score, seq_ratio
from tessera.functions.status import division_compatible
from tessera.functions.common import keep_computed
from tessera.functions.text import word_tokens

def fuzzy_candidates(left: DataFrame, master: DataFrame, *, name: str = "name",
                     master_id: str = "row_id", master_name: str = "master_name",
                     scorer: str = "combined", pref: str | None = None, master_conf: str | None = None,
                     bonus: float = BONUS, left_attr: str | None = None, master_attr: str | None = None,
                     min_score: float = 0.0, seq: Callable[[Column, Column], Column] = seq_ratio) -> DataFrame:
    """All scored candidate pairs for the distinct left keys (V2: the scorer
    is a parameter, ``combined`` or ``jaccard``, and so is the character part
    of the combined one: ``seq`` takes two name columns).

    With ``min_score`` above 0.4 (combined) or above 0 (Jaccard) the word
    block uses prefix filtering: a pair scoring at least ``min_score``
    without the conference bonus needs Jaccard >= t, t = (min_score-0.4)/0.6
    (combined) or min_score (Jaccard), and then the two names share a token
    among their first ``|x| - ceil(t|x|) + 1`` tokens in one global order
    (rarest master tokens first).  Only those prefix tokens are joined, so
    frequent words stay out of the join key; shared counts are then taken
    from the full token sets.  With a conference bonus t is lowered by what
    the bonus can add, so every pair at or above ``min_score`` is a candidate
    (exact); the pairs of a conference are not listed.

    ``left`` holds the query name (and optionally a preferred conference and
    an attribute such as the division); ``master`` holds ``row_id``, the
    master name, and optionally conference / attribute.
    Returns ``q_name, q_pref, q_attr, row_id, master_name, score, jac, seq``.
    """
    qcols = [F.col(name).alias("q_name"),
             (F.coalesce(F.col(pref), F.lit("")) if pref else F.lit("")).alias("q_pref"),
             (F.coalesce(F.col(left_attr), F.lit("")) if left_attr else F.lit("")).alias("q_attr")]
    q = left.select(*qcols).filter(F.col("q_name").isNotNull()).distinct()
    q = q.withColumn("q_tokens", word_tokens(F.col("q_name")))
    m = master.select(F.col(master_id).alias("row_id"), F.col(master_name).alias("master_name"),
                      (F.coalesce(F.col(master_conf), F.lit("")) if master_conf else F.lit("")).alias("m_conf"),
                      (F.coalesce(F.col(master_attr), F.lit("")) if master_attr else F.lit("")).alias("m_attr"))
    m = m.withColumn("m_tokens", word_tokens(F.col("master_name")))

    # sizes and names ride along with the exploded tokens: one shuffle (the
    # pair count), no joins back to either side
    mcols = ["row_id", "master_name", "m_conf", "m_attr", F.size("m_tokens").alias("nm")]
    # explode_outer + not-null filter: a plain explode makes Spark infer a
    # size(tokens) > 0 filter and push it below the projection, tokenising twice
    m_tok = m.select(*mcols, F.explode_outer("m_tokens").alias("tok")).filter(F.col("tok").isNotNull())
    q_tok = q.select("q_name", "q_pref", "q_attr", F.size("q_tokens").alias("nq"),
                     F.explode_outer("q_tokens").alias("tok")).filter(F.col("tok").isNotNull())
    keys = ["q_name", "q_pref", "q_attr", "nq", "row_id", "master_name", "m_conf", "m_attr", "nm"]
    bonus_room = bonus if pref and master_conf else 0.0
    tau = (min_score if scorer == "jaccard" else (min_score - bonus_room - SEQ_WEIGHT) / JAC_WEIGHT) if min_score else 0.0
    if tau > 0:
        # global token order: master document frequency, then the token
        dfreq = m_tok.groupBy("tok").agg(F.count(F.lit(1)).alias("_df"))

        def prefix(tok_df, ids, n_col):
            x = tok_df.join(dfreq, "tok", "left").withColumn("_df", F.coalesce("_df", F.lit(0)))
            w = Window.partitionBy(*ids).orderBy("_df", "tok")
            plen = F.col(n_col) - F.ceil(F.lit(tau - 1e-9) * F.col(n_col)) + 1
            return x.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= plen).drop("_r", "_df")

        mp = prefix(m_tok, ["row_id"], "nm")
        qp = prefix(q_tok, ["q_name", "q_pref", "q_attr"], "nq")
        cand = qp.join(mp, "tok").select(*keys).distinct()
        qt = q.select("q_name", "q_pref", "q_attr", "q_tokens")
        mt_ = m.select("row_id", "m_tokens")
        hits = (cand.join(qt, ["q_name", "q_pref", "q_attr"]).join(mt_, "row_id")
                .select(*keys, F.size(F.array_intersect("q_tokens", "m_tokens")).alias("_hit")))
    else:
        hits = q_tok.join(m_tok, "tok").select(*keys, F.lit(1).alias("_hit"))
    if pref and master_conf and tau <= 0:
        # without a threshold a +bonus pair may share no word: the conference
        # is a second block key (give a ``min_score`` on large masters)
        mc = m.filter(F.col("m_conf") != "").select(*mcols, "m_tokens").withColumn("q_pref", F.col("m_conf"))
        qc = q.filter(F.col("q_pref") != "").select("q_name", "q_pref", "q_attr", "q_tokens",
                                                    F.size("q_tokens").alias("nq"))
        hits = hits.unionByName(qc.join(mc, "q_pref").select(*keys, F.lit(0).alias("_hit")))
    if left_attr and master_attr:
        # C11 is a pair predicate: applied before the pairs are shuffled
        hits = hits.filter(division_compatible(F.col("q_attr"), F.col("m_attr")))
    # token path: one row per shared token (sum = shared count); prefix path:
    # the full intersection size per candidate (max over duplicates)
    pairs = hits.groupBy(*keys).agg((F.max("_hit") if tau > 0 else F.sum("_hit")).alias("shared"))
    jac = F.when((F.col("nq") == 0) | (F.col("nm") == 0), F.lit(0.0)).otherwise(
        F.col("shared") / (F.col("nq") + F.col("nm") - F.col("shared")))
    pairs = pairs.withColumn("jac", jac)
    if scorer == "jaccard":
        pairs = pairs.withColumn("seq", F.lit(None).cast("double")).withColumn("score", F.col("jac"))
    else:
        # one Python call per distinct name pair
        names = pairs.select("q_name", "master_name").distinct()
        names = names.withColumn("seq", seq(F.col("q_name"), F.col("master_name")))
        pairs = pairs.join(names, ["q_name", "master_name"])
        base = F.lit(SEQ_WEIGHT) * F.col("seq") + F.lit(JAC_WEIGHT) * F.col("jac")
        if pref and master_conf:
            base = F.least(F.lit(1.0), base + F.when((F.col("q_pref") != "") & (F.col("q_pref") == F.col("m_conf")),
                                                     F.lit(bonus)).otherwise(F.lit(0.0)))
        pairs = pairs.withColumn("score", base)
    return pairs.select("q_name", "q_pref", "q_attr", "row_id", "master_name", "score", "jac", "seq")


def fuzzy_topk(left: DataFrame, master: DataFrame, k: int = 10, *, name: str = "name",
               master_id: str = "row_id", master_name: str = "master_name", scorer: str = "combined",
               pref: str | None = None, master_conf: str | None = None, left_attr: str | None = None,
               master_attr: str | None = None, min_score: float = 0.0,
               seq: Callable[[Column, Column], Column] = seq_ratio) -> DataFrame:
    """Best ``k`` masters per left row, score desc, master row order
    on ties (the reference's stable sort).  Only strictly positive scores
    (and at least ``min_score``) are returned; ``rank`` is 1-based.
    Output: the left columns + ``rank, row_id, master_name, score, complete``.
    """
    cands = fuzzy_candidates(left, master, name=name, master_id=master_id, master_name=master_name,
                             scorer=scorer, pref=pref, master_conf=master_conf, left_attr=left_attr,
                             master_attr=master_attr, min_score=min_score, seq=seq)
    cands = cands.filter((F.col("score") > 0) & (F.col("score") >= F.lit(min_score)))
    qk = ["q_name", "q_pref", "q_attr"]
    w = Window.partitionBy(*qk).orderBy(F.col("score").desc(), F.col("row_id").asc())
    top = cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    wk = Window.partitionBy(*qk)
    kth = F.max(F.when(F.col("rank") == k, F.col("score"))).over(wk)
    room = BONUS if pref and master_conf else 0.0
    if scorer == "jaccard" or min_score > SEQ_WEIGHT + room:
        complete = F.lit(True)          # every pair >= min_score was a candidate
    else:
        complete = F.coalesce(kth > F.lit(SEQ_WEIGHT), F.lit(False))
    top = top.withColumn("complete", complete)
    lj = left.withColumn("q_name", F.col(name)) \
        .withColumn("q_pref", F.coalesce(F.col(pref), F.lit("")) if pref else F.lit("")) \
        .withColumn("q_attr", F.coalesce(F.col(left_attr), F.lit("")) if left_attr else F.lit(""))
    out = lj.join(top.select(*qk, "rank", "row_id", "master_name", "score", "complete"), qk, "left")
    return out.drop(*qk)


def best_match(left: DataFrame, master: DataFrame, *, name: str = "name", master_id: str = "row_id",
               master_name: str = "master_name", scorer: str = "combined", old_value: str | None = None,
               min_score: float = 0.0, seq: Callable[[Column, Column], Column] = seq_ratio) -> DataFrame:
    """Best master per left row by strict ``>`` from 0.0 (earliest master
    row wins ties; an all-zero row keeps ``old_value``), score rounded
    half-even to 3 places.  Adds ``match_row_id, match_name, similarity_score,
    complete``.  With ``min_score`` only masters at or above it count (prefix
    filter, exact).  Top-1 is a partial aggregate (``max_by``), so no window."""
    cands = fuzzy_candidates(left, master, name=name, master_id=master_id, master_name=master_name,
                             scorer=scorer, min_score=min_score, seq=seq)
    cands = cands.filter((F.col("score") > 0) & (F.col("score") >= F.lit(min_score)))
    best = (cands.groupBy("q_name")
            .agg(F.max_by(F.struct("row_id", "master_name", "score"),
                          F.struct(F.col("score"), (-F.col("row_id")).alias("neg"))).alias("b")))
    best = best.select("q_name", F.col("b.row_id").alias("match_row_id"),
                       F.col("b.master_name").alias("match_name"), F.col("b.score").alias("_score"))
    out = left.join(best, left[name] == best["q_name"], "left").drop("q_name")
    keep = F.col(old_value) if old_value else F.lit(None).cast("string")
    complete = F.lit(True) if scorer == "jaccard" or min_score > SEQ_WEIGHT else F.coalesce(F.col("_score") > SEQ_WEIGHT, F.lit(False))
    return (out.withColumn("match_name", F.coalesce(F.col("match_name"), keep))
            .withColumn("similarity_score", round_score(F.coalesce(F.col("_score"), F.lit(0.0)), 3))
            .withColumn("complete", complete).drop("_score"))


def exact_lookup(left: DataFrame, master: DataFrame, *, name: str = "name", master_id: str = "row_id",
                 master_name: str = "master_name", out: str = "match_row_id") -> DataFrame:
    """E5: first master row whose trimmed lower-case name equals the left's.
    The master is reduced to one row per key (partial aggregate) first."""
    key = lambda c: F.lower(F.trim(F.col(c)))
    firsts = master.groupBy(key(master_name).alias("_k")).agg(F.min(master_id).alias(out))
    return left.withColumn("_k", key(name)).join(firsts, "_k", "left").drop("_k")


def alias_then_fuzzy(left: DataFrame, aliases: DataFrame, master: DataFrame, *, name: str = "name",
                     master_id: str = "row_id", master_name: str = "master_name", scorer: str = "combined",
                     accept_at: float = 0.9) -> DataFrame:
    """An alias pair wins; otherwise the best fuzzy master when its score
    is at least ``accept_at``; otherwise unmatched (null).  The scorer is a
    parameter (decision D9).  Adds ``matched_name, match_source``."""
    al = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canon")).dropDuplicates(["_alias"])
    x = left.join(al, left[name] == F.col("_alias"), "left").drop("_alias")
    fz = best_match(x.filter(F.col("_canon").isNull()).select(name).distinct(), master, name=name,
                    master_id=master_id, master_name=master_name, scorer=scorer,
                    min_score=max(0.0, accept_at - 0.0005))   # scores are rounded to 3 places
    fz = fz.select(F.col(name).alias("_n"), F.when(F.col("similarity_score") >= accept_at, F.col("match_name")).alias("_fz"),
                   "similarity_score")
    y = x.join(fz, x[name] == fz["_n"], "left").drop("_n")
    return (y.withColumn("matched_name", F.coalesce(F.col("_canon"), F.col("_fz")))
            .withColumn("match_source", F.when(F.col("_canon").isNotNull(), F.lit("alias"))
                        .when(F.col("_fz").isNotNull(), F.lit("fuzzy")).otherwise(F.lit("none")))
            .drop("_canon", "_fz"))


def _ngrams(s: Column, n: int) -> Column:
    return F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substring(s, i, n)),
                    lambda g: F.length(g) == n)


def substring_candidates(left: DataFrame, master: DataFrame, *, name: str = "name", master_id: str = "row_id",
                         master_name: str = "master_name", k: int | None = 10, score: bool = True, parts: int = 64) -> DataFrame:
    """Masters whose lower-case name contains the left's lower-case text,
    scored with the combined score, best ``k`` (all when ``k`` is None; no
    score column when ``score`` is False).

    No nested loop: a container holds every gram of the text, so a text joins
    by its rarest one (3 characters, fewer for shorter texts), by one table of
    gram frequencies of the master.  Only grams that some text chose leave the
    master's tasks, the masters of a gram in ``parts`` parts, merged with the
    texts part by part (a broadcast would hold all masters: their grams are
    many times the table); ``contains`` confirms each pair.  The text is one matching
    block of its container, so the character score is 2 * length / both
    lengths (the sequence ratio is computed only for names of 200 characters
    or more, where its own rules differ).  The best ``k`` are taken in two
    steps, so that a short text inside very many names is no hot group."""
    q = left.select(F.col(name).alias("q_name")).filter(F.length(F.trim("q_name")) > 0).distinct() \
        .withColumn("q_low", F.lower("q_name"))
    q = q.withColumn("gn", F.least(F.length("q_low"), F.lit(3)))
    m = master.select(F.col(master_id).alias("row_id"), F.col(master_name).alias("master_name")) \
        .withColumn("m_low", F.lower("master_name"))
    asked = q.select("q_name", "q_low", "gn", F.explode(F.array_distinct(_ngrams(F.col("q_low"), F.col("gn")))).alias("gram"))
    kinds = asked.select("gram").distinct()
    grams = F.flatten(F.array(*[F.array_distinct(_ngrams(F.col("m_low"), F.lit(g))) for g in (1, 2, 3)]))
    index = m.select("row_id", "master_name", "m_low", F.explode(grams).alias("gram"))
    count = index.select("gram").join(F.broadcast(kinds), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    rarest = asked.join(count, "gram").groupBy("q_name", "q_low", "gn").agg(F.min(F.struct("df", "gram")).alias("g"),
                                                                          F.count(F.lit(1)).alias("known"))
    # a text with a gram that no master holds has no container
    whole = F.size(F.array_distinct(_ngrams(F.col("q_low"), F.col("gn"))))
    rarest = rarest.where(F.col("known") == whole).select("q_name", "q_low", F.col("g.gram").alias("gram"))
    held = index.join(F.broadcast(rarest.select("gram").distinct()), "gram", "left_semi").withColumn("_s", F.pmod(F.xxhash64("row_id"), F.lit(parts)))
    rarest = rarest.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    pairs = rarest.hint("merge").join(held, ["gram", "_s"]).filter(F.col("m_low").contains(F.col("q_low")))
    if not score:
        return pairs.select(F.col("q_name").alias(name), "row_id", "master_name")
    tq, tm = word_tokens(F.col("q_name")), word_tokens(F.col("master_name"))
    jac = F.when((F.size(tq) == 0) | (F.size(tm) == 0), F.lit(0.0)).otherwise(
        F.size(F.array_intersect(tq, tm)) / F.size(F.array_union(tq, tm)))
    ratio = lambda p: 2.0 * F.length("q_low") / (F.length("q_low") + F.length("m_low"))
    total = lambda seq: F.lit(SEQ_WEIGHT) * seq + F.lit(JAC_WEIGHT) * jac
    short = pairs.where(F.length("m_low") < 200).withColumn("score", total(ratio(pairs)))
    long = pairs.where(F.length("m_low") >= 200).withColumn("score", total(seq_ratio("q_name", "master_name")))
    pairs = short.unionByName(long).select("q_name", "_s", "row_id", "master_name", "score")
    if k is None:
        return pairs.select(F.col("q_name").alias(name), "row_id", "master_name", "score")
    order = [F.col("score").desc(), "row_id"]
    near = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("q_name", "_s").orderBy(*order))).filter(F.col("_r") <= k)
    top = near.withColumn("rank", F.row_number().over(Window.partitionBy("q_name").orderBy(*order))).filter(F.col("rank") <= k)
    return top.select(F.col("q_name").alias(name), "rank", "row_id", "master_name", "score")


def resolve_matches(cands: DataFrame, decisions: DataFrame | None, *, key: str, accept_at: float):
    """``cands`` = ranked candidates ``(key, rank, row_id, master_name, score)``.

    Auto-accept rank 1 when its score reaches ``accept_at``; a ``decisions``
    table ``(left_key, action, pick_row_id)`` overrides: ``accept`` takes rank
    1, ``pick`` takes the given master row, ``skip`` drops the row.  Returns
    ``(accepted, review_queue)``; the queue holds every undecided key with its
    candidates for a person to look at.
    """
    top = cands.filter(F.col("rank") == 1)
    keys = cands.select(key).distinct()
    if decisions is not None:
        d = decisions.select(F.col("left_key").alias(key), "action", "pick_row_id")
        keys = keys.join(d, key, "left")
    else:
        keys = keys.withColumn("action", F.lit(None).cast("string")).withColumn("pick_row_id", F.lit(None).cast("long"))
    x = keys.join(top.select(key, F.col("row_id").alias("top_row_id"), F.col("score").alias("top_score")), key, "left")
    chosen = (F.when(F.col("action") == "pick", F.col("pick_row_id"))
              .when(F.col("action") == "accept", F.col("top_row_id"))
              .when(F.col("action").isNull() & (F.col("top_score") >= accept_at), F.col("top_row_id")))
    x = x.withColumn("chosen_row_id", chosen)
    accepted = x.filter(F.col("chosen_row_id").isNotNull()).select(
        key, "chosen_row_id", F.coalesce("action", F.lit("auto")).alias("how"))
    pending = x.filter(F.col("chosen_row_id").isNull() & (F.coalesce(F.col("action"), F.lit("")) != "skip")).select(key)
    review = pending.join(cands, key, "left")
    return accepted, review


def set_similarity_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_text: str,
                        right_text: str, threshold: float) -> DataFrame:
    """S27 + E1 with a threshold: all (left, right) pairs whose word-set
    Jaccard is at least ``threshold`` (> 0).

    Exact pruning before any pair exists:
    * size: Jaccard >= t needs ``t*|B| <= |A| <= |B|/t`` (in the join, and
      against the right side's whole size range before it);
    * prefix: in one global order, rarest on the right side first, the two
      sets share a token among their first ``|x| - ceil(t|x|) + 1``.  Words
      that the right side lacks come first and join nothing, so a text with
      many of them may have no prefix token left.
    Pairs that meet on a prefix token are verified on the whole sets.
    Output: ``left_id, right_id, shared, jaccard``.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    t = F.lit(threshold - 1e-9)
    L = keep_computed(left.select(F.col(left_id).alias("_lid"), word_tokens(F.col(left_text)).alias("_t"))) \
        .withColumn("_nl", F.size("_t"))
    R = right.select(F.col(right_id).alias("_rid"), word_tokens(F.col(right_text)).alias("_u")) \
        .withColumn("_nr", F.size("_u")).filter(F.col("_nr") > 0)
    lo_hi = R.agg(F.min("_nr").alias("lo"), F.max("_nr").alias("hi")).first()
    if lo_hi is None or lo_hi["lo"] is None:
        return left.sparkSession.createDataFrame(
            [], f"{left_id} {left.schema[left_id].dataType.simpleString()}, "
                f"{right_id} {right.schema[right_id].dataType.simpleString()}, shared bigint, jaccard double")
    L = L.filter((F.col("_nl") >= t * lo_hi["lo"]) & (F.col("_nl") * t <= lo_hi["hi"])
                 & (F.col("_barrier") >= 0)).drop("_barrier")
    rt = R.select("_rid", "_nr", F.explode_outer("_u").alias("tok")).filter(F.col("tok").isNotNull())
    freq = rt.groupBy("tok").agg(F.count(F.lit(1)).alias("_df"))
    lt = L.select("_lid", "_nl", F.explode_outer("_t").alias("tok")).filter(F.col("tok").isNotNull()).join(freq, "tok")

    def prefix(tok_df, ident, n):
        w = Window.partitionBy(ident)
        x = tok_df.withColumn("_r", F.row_number().over(w.orderBy("_df", "tok"))).withColumn("_in", F.count(F.lit(1)).over(w))
        first = F.col(n) - F.ceil(t * F.col(n)) + 1 - (F.col(n) - F.col("_in"))
        return x.filter(F.col("_r") <= first).select(ident, n, "tok")

    lp, rp = prefix(lt, "_lid", "_nl"), prefix(rt.join(freq, "tok"), "_rid", "_nr")
    cond = (lp["tok"] == rp["tok"]) & (F.col("_nl") >= t * F.col("_nr")) & (F.col("_nl") * t <= F.col("_nr"))
    cand = lp.join(rp, cond).select("_lid", "_rid").distinct()
    pairs = cand.join(R, "_rid").join(L, "_lid").withColumn("shared", F.size(F.array_intersect("_t", "_u")).cast("long"))
    jac = F.col("shared") / (F.col("_nl") + F.col("_nr") - F.col("shared"))
    return (pairs.withColumn("jaccard", jac).filter(F.col("jaccard") >= F.lit(threshold))
            .select(F.col("_lid").alias(left_id), F.col("_rid").alias(right_id), "shared", "jaccard"))
