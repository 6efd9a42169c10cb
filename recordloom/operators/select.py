"""Diversified selection without a sequential loop over all records.

Whether a record is admitted depends on its own journal alone: hard cap,
near-duplicate titles and topic caps. Journals meet only in the order of turns
and in the global target. So each journal is played through on its own as if
there were no target (``greedy``: by frontiers, so that no task holds a journal);
what a journal has taken, no more than its cap, gives the key of each turn and,
for every other row, the turn at which it came up and what blocked it then. The
turns that took a row are put in order, and the target cuts them.
"""

from __future__ import annotations

from collections import Counter, deque
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.rules import weights
from recordloom.functions.text import filled
from recordloom.operators import greedy
from recordloom.operators.caps import top_per_group
from recordloom.operators.joins import small
from recordloom.operators.orders import places
from recordloom.plans.lineage import cut
from recordloom.plans.policy import FirstShortlistPolicy, ReviewPolicy, ShortlistPolicy

def capture(percentile, unknown, policy: ShortlistPolicy):
    """The capture rate of a percentile's band."""
    chain = F.when(unknown, policy.unknown_rate)
    for least, rate in policy.bands:
        chain = chain.when(percentile >= least, rate)
    return chain


def contexts(records: DataFrame, priors: DataFrame, policy: ShortlistPolicy | None = None) -> DataFrame:
    """One row a journal: its counts, capture rate, hard cap and adaptive target.

    ``records`` has journal_slug, route, processing_mode and fetchable;
    ``priors`` has slug, registry_category_percentile and unknown_metric.
    """
    p = policy or ShortlistPolicy()
    eligible = F.col("route").isin(*p.eligible)
    made = records.groupBy("journal_slug").agg(
        F.min("processing_mode").alias("processing_mode"), F.count(F.lit(1)).alias("articles"),
        F.count_if(eligible).alias("eligible"), F.count_if(eligible & F.col("fetchable")).alias("fetchable"),
        F.count_if(F.col("route").isin(*p.independent) & F.col("fetchable")).alias("candidates"),
    )
    joined = made.join(priors, made["journal_slug"] == priors["slug"], "left").drop("slug")
    joined = joined.withColumn("percentile", F.coalesce("registry_category_percentile", F.lit(p.neutral_percentile))).withColumn("unknown_metric", F.coalesce("unknown_metric", F.lit(True)))
    rate, modifier, cap = capture(F.col("percentile"), F.col("unknown_metric"), p), F.try_element_at(weights(p.capture_modifiers), F.col("processing_mode")), F.try_element_at(weights(p.journal_caps), F.col("processing_mode"))
    share = F.ceil(F.col("fetchable") * rate * modifier)
    return joined.withColumn("capture_rate", rate).withColumn("hard_cap", cap).withColumn("target", F.least("fetchable", cap, F.greatest("candidates", share)))


_HISTORY = "array<struct<phase:int,turn:int,held:int,pos:bigint,rest:bigint,key:string,tokens:array<string>,topic:string>>"


def _mode(caps: dict, mode: str = "processing_mode") -> Column:
    return F.coalesce(F.try_element_at(weights(caps), F.col(mode)), F.lit(0))


def _count(hist: Column, keep) -> Column:
    return F.size(F.filter(hist, keep))


def _turn_key(phase: int, turn: Column, held: Column) -> Column:
    """When a journal's turn comes: earlier phases first, then by what is known when it begins."""
    of = lambda c: F.greatest(F.lit(1), F.col(c))
    zero, hist = F.lit(0.0), F.col("hist")
    if phase == 1:
        keys = [held / of("candidates"), zero, zero]
    elif phase == 2:
        keys = [-F.col("percentile"), held / of("target"), zero]
    else:
        # What is left of the pool: all but those of the phases before, and but those up to the row that the turn before took.
        last = F.coalesce(F.get(F.filter(hist, lambda h: (h["phase"] == 3) & (h["turn"] == turn - 1)), F.lit(0))["rest"], F.lit(0))
        left = F.col("pool") - last - _count(hist, lambda h: (h["phase"] < 3) & (h["rest"] > last))
        keys = [-F.col("percentile"), held / of("fetchable_count"), -left.cast("double")]
    return F.struct(F.lit(phase).alias("phase"), turn.alias("turn"), *(k.cast("double").alias(f"k{i}") for i, k in enumerate(keys, 1)), F.col("g"))


def diversified(records: DataFrame, context: DataFrame, policy: ShortlistPolicy | None = None) -> tuple[DataFrame, DataFrame]:
    """(selected, blocks) of the capped, diversified, prior-aware selection.

    ``records``: journal_slug, record_key, route, processing_mode, fetchable,
    tokens, topic_signature, place (a journal's rows in order) and turn (its
    path-interleaved order, within routes). ``selected`` has record_key, ordinal
    and reason; ``blocks`` has the reasons of rows that came up and were not taken.
    """
    p = policy or ShortlistPolicy()
    journals = context.select(F.col("journal_slug").alias("g"), "percentile", "hard_cap", "candidates", "target", F.col("fetchable").alias("fetchable_count"))
    rows = records.filter(F.col("route").isin(*p.eligible)).select(
        F.col("journal_slug").alias("g"), F.col("record_key").alias("key"), F.array_distinct("tokens").alias("tokens"), F.col("topic_signature").alias("topic"), F.col("turn").cast("long").alias("turn_place"),
        "place", (~F.col("route").isin(*p.independent)).alias("later"), (F.col("route") == "RESERVE").alias("reserve"), "fetchable", _mode(p.topic_soft_caps).alias("soft"), _mode(p.topic_hard_caps).alias("hard"),
    )
    rows = rows.join(small(journals.select("g", "hard_cap", "target")), "g")
    rows = cut(places(rows, ["g"], ["later", "place", "key"], "rest").withColumn("rest", F.col("rest").cast("long")))
    pools = {1: (~F.col("later"), F.col("turn_place"), "soft", F.col("hard_cap")), 2: (F.col("reserve"), F.col("turn_place"), "soft", F.least("hard_cap", "target")), 3: (F.lit(True), F.col("rest"), "hard", F.col("hard_cap"))}
    taken = rows.sparkSession.createDataFrame([], greedy.TAKEN)
    for phase, (pool, pos, topics, stop) in pools.items():
        playing = rows.filter(pool & F.col("fetchable")).select("g", "key", pos.alias("pos"), "rest", "tokens", "topic", F.col(topics).alias("topic_cap"), stop.alias("stop"))
        taken = greedy.choose(playing, taken, phase, p.near_duplicate)

    sizes = rows.groupBy("g").agg(F.max("rest").alias("pool"))
    of = cut(journals.join(sizes, "g").join(greedy.histories(taken), "g", "left").withColumn("hist", F.coalesce("hist", F.array().cast(_HISTORY))))
    reasons = F.element_at(F.array(*map(F.lit, ("METRIC_INDEPENDENT_PREFETCH_CANDIDATE", "IMPACT_ADAPTIVE_TARGET", "IMPACT_GLOBAL_BUDGET_FILL"))), F.col("h.phase"))
    each = of.withColumn("h", F.explode("hist"))
    at = F.when(F.col("h.phase") == 1, _turn_key(1, F.col("h.turn"), F.col("h.held"))).when(F.col("h.phase") == 2, _turn_key(2, F.col("h.turn"), F.col("h.held"))).otherwise(_turn_key(3, F.col("h.turn"), F.col("h.held")))
    turns = cut(each.select(F.col("h.key").alias("record_key"), F.col("g").alias("journal_slug"), reasons.alias("reason"), at.alias("at")))
    first = turns.orderBy("at").limit(p.target)
    selected = cut(first.withColumn("ordinal", F.row_number().over(Window.orderBy("at")).cast("long")))  # of the target's rows alone
    last = selected.agg(F.max("at").alias("__last"), F.count(F.lit(1)).alias("__n"))

    known = rows.join(small(of.drop("hard_cap", "target"), greedy.MAX_STATES), "g").crossJoin(F.broadcast(last))  # one row beside each

    def came_up(phase: int, pool: Column, pos: Column, topics: str) -> DataFrame:
        """(key, block) of the pool's rows that came up in a turn before the target was met, and weren't taken."""
        hist = F.col("hist")
        earlier, own = lambda h: h["phase"] < phase, lambda h: h["phase"] == phase
        turn = _count(hist, lambda h: own(h) & (h["pos"] < pos)) + 1
        held = _count(hist, earlier) + turn - 1
        gone = F.exists(hist, lambda h: (h["key"] == F.col("key")) & (own(h) | (earlier(h) & F.lit(phase == 3))))
        up = known.filter(pool & ~gone).withColumn("t", turn).withColumn("h", held)
        if phase == 2:
            up = up.filter(F.col("h") < F.col("target"))
        up = up.filter((F.col("__n") < p.target) | (_turn_key(phase, F.col("t"), F.col("h")) <= F.col("__last")))
        before = F.filter(hist, lambda h: earlier(h) | (own(h) & (h["pos"] < pos)))
        return up.withColumn("before", before).select("key", _block(F.col("before"), F.col(topics), phase == 3, p.near_duplicate).alias("block"))

    came = [came_up(phase, pool, pos, topics) for phase, (pool, pos, topics, _) in pools.items()]
    blocks = reduce(DataFrame.unionByName, came).filter("block is not null").select(F.col("key").alias("record_key"), "block").distinct()
    return selected.select("record_key", "journal_slug", "ordinal", "reason"), blocks


def _block(before: Column, topic_cap: Column, hard: bool, near: float) -> Column:
    """Why what its journal held ``before`` blocks a row; null if nothing does."""
    return (
        F.when(~F.col("fetchable"), "NO_FETCHABLE_IDENTIFIER").when(F.size(before) >= F.col("hard_cap"), "JOURNAL_FETCH_HARD_CAP")
        .when(F.exists(before, lambda h: greedy.similar(h["tokens"], F.col("tokens"), near)), "NEAR_DUPLICATE_TITLE")
        .when(_count(before, lambda h: h["topic"].eqNullSafe(F.col("topic"))) >= topic_cap, "TOPIC_HARD_CAP" if hard else "TOPIC_SOFT_CAP")
    )


def final_blocks(records: DataFrame, selected: DataFrame, context: DataFrame, policy: ShortlistPolicy | None = None) -> DataFrame:
    """(record_key, block) of eligible rows that weren't selected, against what was, which is no more than the target; else the global ceiling."""
    p = policy or ShortlistPolicy()
    rows = records.filter(F.col("route").isin(*p.eligible)).select("journal_slug", "record_key", F.array_distinct("tokens").alias("tokens"), F.col("topic_signature").alias("topic"), "fetchable", _mode(p.topic_hard_caps).alias("hard"))
    chosen = F.broadcast(selected.select("record_key", F.lit(True).alias("__in")))
    marked = rows.join(chosen, "record_key", "left")
    held = cut(marked.filter("__in").groupBy("journal_slug").agg(F.collect_list(F.struct("tokens", "topic")).alias("before")))
    left = marked.filter("__in is null").join(small(context.select("journal_slug", "hard_cap")), "journal_slug").join(F.broadcast(held), "journal_slug", "left")
    left = left.withColumn("before", F.coalesce("before", F.array().cast("array<struct<tokens:array<string>,topic:string>>")))
    return left.select("record_key", F.coalesce(_block(F.col("before"), F.col("hard"), True, p.near_duplicate), F.lit("GLOBAL_MONTHLY_SOFT_CEILING")).alias("block"))


def review_selection(rows: DataFrame, policy: ReviewPolicy | None = None) -> DataFrame:
    """Journals in turn, best first; adds ordinal and reason.

    ``rows``: journal_slug, record_key, processing_mode, score, percentile,
    prefetch_score, title and tokens. A rejected row uses up its journal's
    turn; rows after the target have the target as their reason.
    """
    p = policy or ReviewPolicy()
    best = [F.desc("score"), F.desc("percentile"), F.desc("prefetch_score"), F.lower("title"), F.col("record_key")]
    named = rows.select(F.col("journal_slug").alias("g"), F.col("record_key"), "score", "percentile", "prefetch_score", "title", F.array_distinct("tokens").alias("tokens"), _mode(p.journal_caps).alias("stop"))
    ranked = cut(places(named, ["g"], best, "round").select("g", F.col("record_key").alias("key"), F.col("round").cast("long").alias("pos"), "tokens", "stop", "score", "percentile"))
    playing = ranked.select("g", "key", "pos", F.col("pos").alias("rest"), "tokens", F.lit("").alias("topic"), F.lit((1 << 31) - 1).alias("topic_cap"), "stop")
    taken = greedy.choose(playing, ranked.sparkSession.createDataFrame([], greedy.TAKEN), 1, p.near_duplicate)
    of = ranked.filter("pos = 1").select("g", F.col("score").alias("top_score"), F.col("percentile").alias("top_percentile")).join(greedy.histories(taken), "g", "left").withColumn("hist", F.coalesce("hist", F.array().cast(_HISTORY)))
    known = ranked.join(small(cut(of), greedy.MAX_STATES), "g")
    before = F.filter("hist", lambda h: h["pos"] < F.col("pos"))
    reason = F.when(F.exists("hist", lambda h: h["pos"] == F.col("pos")), "ABSTRACT_STRUCTURAL_REVIEW").when(F.size(before) >= F.col("stop"), "JOURNAL_FULLTEXT_CAP").otherwise("NEAR_DUPLICATE_ABSTRACT_CANDIDATE")
    at = F.struct(F.col("pos").alias("round"), (-F.col("top_score")).alias("s"), (-F.col("top_percentile")).alias("p"), "g")
    marked = cut(known.select(F.col("g").alias("journal_slug"), F.col("key").alias("record_key"), reason.alias("reason"), at.alias("at")))
    first = marked.filter("reason = 'ABSTRACT_STRUCTURAL_REVIEW'").orderBy("at").limit(p.target)
    chosen = cut(first.withColumn("ordinal", F.row_number().over(Window.orderBy("at")).cast("long")))  # of the target's rows alone
    last = chosen.agg(F.max("at").alias("__last"), F.count(F.lit(1)).alias("__n"))
    late = (F.col("__n") >= p.target) & (F.col("at") > F.col("__last"))
    ordinals = F.broadcast(chosen.select("at", "ordinal"))
    out = marked.crossJoin(F.broadcast(last)).withColumn("reason", F.when(late, "FULLTEXT_GLOBAL_TARGET_OR_RELATIVE_PRIORITY").otherwise(F.col("reason")))  # one row beside each
    return out.join(ordinals, "at", "left").select("journal_slug", "record_key", "ordinal", "reason")


class _Shortlist:
    """What has been taken across journals, and whether a row may still be; every attempt at a pool is noted."""

    def __init__(self, policy: FirstShortlistPolicy) -> None:
        self.p = policy
        self.taken: dict = {}  # record_key -> (row, reason), in order
        self.journal, self.path, self.category, self.topic = Counter(), Counter(), Counter(), Counter()
        self.titles: dict[str, list[frozenset]] = {}
        self.attempts: dict[tuple[str, str], dict[tuple[bool, int], int]] = {}

    def cap(self, row) -> int:
        return self.p.journal_caps.get(row.processing_mode or "FULL", 0)

    def closed(self, kind: str, hard: bool) -> list[str]:
        counts, caps = (self.path, self.p.paths) if kind == "primary_path" else (self.category, self.p.categories)
        return [x for x, limits in caps.items() if counts[x] >= limits[2 if hard else 1]]

    def capped(self, row, hard: bool) -> bool:
        """Whether counts alone block the row, and so all rows of its journal, topic, path and category."""
        p, phase = self.p, 2 if hard else 1
        limit = lambda caps, x: caps.get(x, (0, p.target, p.target))[phase]
        return (
            self.topic[row.journal_slug, row.topic_signature] >= p.topic_cap or self.journal[row.journal_slug] >= self.cap(row)
            or self.path[row.primary_path] >= limit(p.paths, row.primary_path) or self.category[row.primary_category] >= limit(p.categories, row.primary_category)
        )

    def free(self, row, hard: bool) -> bool:
        """What blocks a row once goes on to, as counts only rise and titles are only added."""
        tokens = frozenset(row.tokens or ())
        return row.record_key not in self.taken and not self.capped(row, hard) and not any(greedy.jaccard(tokens, t) >= self.p.near_duplicate for t in self.titles.get(row.journal_slug, ()))

    def take(self, row, reason: str) -> None:
        self.taken[row.record_key] = (row, reason)
        self.journal[row.journal_slug] += 1
        self.path[row.primary_path] += 1
        self.category[row.primary_category] += 1
        self.topic[row.journal_slug, row.topic_signature] += 1
        self.titles.setdefault(row.journal_slug, []).append(frozenset(row.tokens or ()))

    def note(self, pool: str, name: str, hard: bool, before: int, reach: int) -> None:
        seen = self.attempts.setdefault((pool, name), {})
        seen[hard, before] = max(reach, seen.get((hard, before), 0))


_SEEN = ("record_key", "journal_slug", "processing_mode", "primary_path", "primary_category", "topic_signature", "tokens")
#: Beyond any place in a pool: an attempt that took nothing went through all of it.
_ALL = 1 << 62


def _in_turn(rows: DataFrame, pool: str, best: list[Column], name: str) -> DataFrame:
    """Rows with their place in their pool: journals take turns, each best first, in the order of their best rows."""
    ranked = places(rows.withColumn("__key", F.struct(*best)), [pool, "journal_slug"], ["__key"], "__round")
    first = ranked.groupBy(F.col(pool).alias("__pool"), F.col("journal_slug").alias("__slug")).agg(F.min("__key").alias("__first"))
    joined = ranked.join(small(first), F.col(pool).eqNullSafe(F.col("__pool")) & F.col("journal_slug").eqNullSafe(F.col("__slug")))
    return places(joined, [pool], ["__round", "__first"], name).drop("__key", "__round", "__first", "__pool", "__slug")


def _taken_rows(rows: DataFrame, state: _Shortlist) -> DataFrame:
    """(journal_slug, hist): what each journal has had taken, in order; no more than the target in all."""
    said = [(r.journal_slug, k, list(r.tokens or ()), r.topic_signature) for k, (r, _) in enumerate(state.taken.values())]
    df = rows.sparkSession.createDataFrame(said, "journal_slug string, k int, tokens array<string>, topic string")
    return F.broadcast(df.groupBy("journal_slug").agg(F.array_sort(F.collect_list(F.struct("k", "tokens", "topic"))).alias("hist")))


class _Pools:
    """The rows of each pool that may be next, in order: of every cell (journal, topic, path, category) the first few.

    Counts block a cell as a whole, so only near copies of what was taken can
    use up a cell's rows while it is open. A row that is the last known of its
    cell, journal or pool is marked; only when the play passes such a row and
    what it stands for is still open, all pools are fetched once more, without
    what is blocked by then.
    """

    def __init__(self, rows: DataFrame, pool: str, at: str, state: _Shortlist, batch: int) -> None:
        self.rows, self.pool, self.at, self.state = rows.filter(F.col(at).isNotNull() & F.col("fetchable")), pool, at, state
        self.batch, self.a_journal, self.a_cell = batch, max(2, batch // 8), max(1, min(batch // 4, state.p.topic_cap + 4))
        self.held: dict[str, deque] | None = None
        self.hard = False

    def phase(self, hard: bool) -> None:
        self.held, self.hard = None, hard

    def _fetch(self) -> None:
        free, p = self.rows, self.state.p
        if self.state.taken:
            free = free.join(_taken_rows(self.rows, self.state), "journal_slug", "left").withColumn("hist", F.coalesce("hist", F.array().cast("array<struct<k:int,tokens:array<string>,topic:string>>")))
            free = free.filter((F.size("hist") < _mode(p.journal_caps, "mode")) & ~greedy.blocked(F.col("hist"), F.col("tokens"), F.col("topic_signature"), p.near_duplicate, F.lit(p.topic_cap)))
            free = free.filter(~F.col("primary_path").isin(self.state.closed("primary_path", self.hard)) & ~F.col("primary_category").isin(self.state.closed("primary_category", self.hard)) & ~F.col("record_key").isin(list(self.state.taken)))
        cells = top_per_group(free, ["journal_slug", "topic_signature", "primary_path", "primary_category"], [F.col(self.at)], self.a_cell, rank="__c")
        journals = top_per_group(cells, [self.pool, "journal_slug"], [F.col(self.at)], self.a_journal, rank="__j")
        best = top_per_group(journals, [self.pool], [F.col(self.at)], self.batch, rank="__n")
        marks = (F.col("__c") == self.a_cell).alias("cell_ends"), (F.col("__j") == self.a_journal).alias("journal_ends"), (F.col("__n") == self.batch).alias("pool_ends")
        self.held = {}
        for r in sorted(best.select(F.col(self.at).alias("at"), *_SEEN, *marks).collect(), key=lambda r: r["at"]):
            self.held.setdefault(r[self.pool], deque()).append(r)

    def _hides(self, row) -> bool:
        """Whether rows that aren't known may be free behind this one."""
        journal_open = self.state.journal[row.journal_slug] < self.state.cap(row)
        return row.pool_ends or (row.journal_ends and journal_open) or (row.cell_ends and not self.state.capped(row, self.hard))

    def take(self, name: str, reason: str) -> bool:
        """Takes the pool's next row that isn't blocked; says whether there was one."""
        before, reach = len(self.state.taken), _ALL
        while name not in self.state.closed(self.pool, self.hard):
            if self.held is None:
                self._fetch()
            queue = self.held.get(name)
            if not queue:
                break
            row = queue.popleft()
            if self.state.free(row, self.hard):
                self.state.take(row, reason)
                reach = row.at
            if self._hides(row):
                self.held = None
            if reach != _ALL:
                break
        self.state.note(self.at, name, self.hard, before, reach)
        return reach != _ALL


def _reasons(rows: DataFrame, state: _Shortlist) -> Column:
    """What blocked each row, at every attempt that came to it and at the end; ``rows`` has ``hist`` and the attempts of its pools."""
    p = state.p
    order = list(state.taken.values())

    def full(kind: str, caps: dict, phase: int) -> Column:
        """How many rows had been taken when a path or category was full; null if never."""
        seen, at = Counter(), {x: 0 for x, limits in caps.items() if limits[phase] == 0}
        for k, (r, _) in enumerate(order, 1):
            seen[r[kind]] += 1
            if seen[r[kind]] == caps.get(r[kind], (0, p.target, p.target))[phase]:
                at[r[kind]] = k
        return F.try_element_at(weights(at), F.col(kind)) if at else F.lit(None).cast("int")

    hist, nth = F.col("hist"), lambda found, n: F.get(found, n - 1)["k"] + 1
    near = nth(F.filter(hist, lambda h: greedy.similar(h["tokens"], F.array_distinct(F.coalesce("tokens", F.array().cast("array<string>"))), p.near_duplicate)), F.lit(1))
    topic = nth(F.filter(hist, lambda h: h["topic"].eqNullSafe(F.col("topic_signature"))), F.lit(p.topic_cap))
    cap = _mode(p.journal_caps, "mode")
    journal = F.when(cap == 0, 0).otherwise(nth(hist, F.greatest(cap, F.lit(1))))
    since = F.struct(near.alias("near"), topic.alias("topic"), journal.alias("journal"), *(full(kind, caps, n).alias(f"{word}_{n}") for kind, caps, word in (("primary_path", p.paths, "path"), ("primary_category", p.categories, "category")) for n in (1, 2)))

    def reason(s: Column, hard: Column, k: Column) -> Column:
        by = lambda c: s[c] <= k
        chain = F.when(by("near"), "NEAR_DUPLICATE_TITLE").when(by("topic"), "TOPIC_SOFT_CAP").when(by("journal"), "JOURNAL_FETCH_CAP")
        for word in ("path", "category"):
            chain = chain.when(~hard & by(f"{word}_1"), f"{word.upper()}_SOFT_CAP").when(hard & by(f"{word}_2"), f"{word.upper()}_HARD_CAP")
        return chain

    def of_row(s: Column) -> Column:
        came = F.array_compact(F.transform("attempts", lambda a: reason(s, a["hard"], a["k"])))
        at_end = F.coalesce(reason(s, F.lit(True), F.lit(len(order))), F.lit("FETCH_NOW_GLOBAL_TARGET"))
        return F.array_sort(F.array_distinct(F.concat(came, F.array(at_end))))

    found = F.get(F.transform(F.array(since), of_row), F.lit(0))
    return F.when(~F.coalesce("fetchable", F.lit(False)), F.array(F.lit("NO_FETCHABLE_IDENTIFIER"))).otherwise(found)


def first_shortlist(rows: DataFrame, policy: FirstShortlistPolicy | None = None, batch: int = 240) -> DataFrame:
    """Every row with editorial_route (FETCH_NOW, HOLD_RESERVE, CATALOG_ONLY), ordinal, hold_ordinal, reason and blocks.

    ``rows``: record_key, journal_slug, journal, processing_mode, route, primary_path, primary_category, score,
    publication_date (a number), title, tokens, topic_signature, fetchable. Candidates fill the floors of the
    categories, then those of the paths, then all paths in turn under soft caps and then under hard ones, until the
    target is met; what is left is filled from the reserve. Within a category or path journals take turns.

    The selection is sequential, its state no larger than the target; it is played on a frontier of rows that a job a
    pass fetches (``_Pools``), and no row is left out of what that job reads. ``blocks`` has what blocked a row each time
    that a pass came to it, worked out where the row stands from the attempts and what was taken by then. Held rows obey
    caps by topic and journal that ranks express.
    """
    p = policy or FirstShortlistPolicy()
    state = _Shortlist(p)
    rows = cut(rows)  # every job reads them, none makes them anew
    places_of = {k: i for i, k in enumerate(p.paths)}
    rank_of_path = F.coalesce(F.try_element_at(weights(places_of), F.col("primary_path")), F.lit(999))
    best = [(-F.col("score")).alias("s"), (-F.col("publication_date")).alias("d"), F.lower(F.coalesce("journal", F.lit(""))).alias("j"), F.lower(F.coalesce("title", F.lit(""))).alias("t"), F.col("record_key").alias("k")]
    known = F.col("primary_path").isin(*p.paths)
    pooled = known & F.col("route").isin(*p.sources, "RESERVE")
    # A candidate is in the pools of its category and its path, a reserve row in that of its path.
    lane = F.when(F.col("route").isin(*p.sources), F.concat(F.lit("c:"), "primary_path")).otherwise(F.concat(F.lit("r:"), "primary_path"))
    in_pools = rows.filter(pooled).withColumn("mode", filled(F.col("processing_mode"), "FULL")).withColumn("__lane", lane)
    by_path = _in_turn(in_pools, "__lane", best, "__place")
    categories = _in_turn(in_pools.filter(F.col("route").isin(*p.sources)).select("record_key", "journal_slug", "primary_path", "primary_category", "score", "publication_date", "journal", "title"), "primary_category", [rank_of_path.alias("r"), *best], "in_category")
    placed = by_path.join(categories.select("record_key", "in_category"), "record_key", "left")
    placed = placed.withColumn("in_path", F.when(F.col("route").isin(*p.sources), F.col("__place"))).withColumn("in_reserve", F.when(F.col("route") == "RESERVE", F.col("__place")))
    placed = cut(placed.select(*_SEEN, "mode", "route", "fetchable", "in_category", "in_path", "in_reserve"))

    by_category, by_path = _Pools(placed, "primary_category", "in_category", state, batch), _Pools(placed, "primary_path", "in_path", state, batch)
    for name, (floor, _, _) in p.categories.items():
        while state.category[name] < floor and by_category.take(name, f"CATEGORY_FLOOR:{name}"):
            pass
    for name, (floor, _, _) in p.paths.items():
        while state.path[name] < floor and by_path.take(name, f"PATH_FLOOR:{name}"):
            pass

    def fill(pools: _Pools, reason: str) -> None:
        moved = True
        while moved and len(state.taken) < p.target:
            moved = False
            for name in p.paths:
                if len(state.taken) < p.target:
                    moved = pools.take(name, reason) or moved

    fill(by_path, "BALANCED_SOFT_FILL")
    by_path.phase(hard=True)
    fill(by_path, "BALANCED_HARD_FILL")
    if p.backfill and len(state.taken) < p.target:
        spare = _Pools(placed, "primary_path", "in_reserve", state, batch)
        spare.phase(hard=True)
        fill(spare, "PREFETCH_RESERVE_BACKFILL")

    spark, kind = rows.sparkSession, rows.schema["record_key"].dataType.simpleString()
    chosen = spark.createDataFrame([(k, i, why) for i, (k, (_, why)) in enumerate(state.taken.items(), 1)], f"record_key {kind}, ordinal int, reason string")
    marked = rows.join(F.broadcast(chosen), "record_key", "left")
    open_rows = marked.filter(F.col("ordinal").isNull() & F.col("route").isin("FETCH_CANDIDATE", "RESERVE"))
    lane = F.when(F.col("route") == "RESERVE", len(places_of) + 1).otherwise(0) + F.when(known, rank_of_path).otherwise(len(places_of))
    cap = F.coalesce(F.try_element_at(weights(p.hold_caps_by_mode), filled(F.col("processing_mode"), "FULL")), F.lit(0))
    turns = _in_turn(open_rows.withColumn("lane", lane).withColumn("__cap", cap), "lane", best, "__place").withColumn("at", F.struct("lane", "__place"))
    topical = top_per_group(turns, ["journal_slug", "topic_signature"], [F.col("at")], p.hold_topic_cap, rank="__t").drop("__t")
    within = top_per_group(topical, ["journal_slug"], [F.col("at")], F.col("__cap"), most=max(p.hold_caps_by_mode.values()), rank="__j")
    held = within.orderBy("at").limit(p.hold_target).select("record_key", F.row_number().over(Window.orderBy("at")).alias("hold_ordinal"))  # of the target's rows alone

    # No more attempts than pools and what the target lets them take.
    tried = [(pool, name, [(hard, k, reach) for (hard, k), reach in seen.items()]) for (pool, name), seen in state.attempts.items()]
    tried = spark.createDataFrame(tried, "pool string, name string, tried array<struct<hard:boolean,k:int,reach:bigint>>")
    reached = placed.join(_taken_rows(placed, state), "journal_slug", "left").withColumn("hist", F.coalesce("hist", F.array().cast("array<struct<k:int,tokens:array<string>,topic:string>>"))).withColumn("attempts", F.array().cast("array<struct<hard:boolean,k:int,reach:bigint>>"))
    for at, of in (("in_category", "primary_category"), ("in_path", "primary_path"), ("in_reserve", "primary_path")):
        own = F.broadcast(tried.filter(F.col("pool") == at).select(F.col("name").alias(of), "tried"))
        more = F.filter(F.coalesce("tried", F.array().cast("array<struct<hard:boolean,k:int,reach:bigint>>")), lambda a: a["reach"] > F.col("__at"))
        reached = reached.withColumn("__at", F.coalesce(at, F.lit(_ALL))).join(own, of, "left").withColumn("attempts", F.concat("attempts", more)).drop("tried", "__at")
    others = marked.filter(F.col("route").isin("FETCH_CANDIDATE", "RESERVE") & ~F.coalesce(pooled, F.lit(False)))
    others = others.join(_taken_rows(rows, state), "journal_slug", "left").withColumn("mode", filled(F.col("processing_mode"), "FULL")).withColumn("hist", F.coalesce("hist", F.array().cast("array<struct<k:int,tokens:array<string>,topic:string>>"))).withColumn("attempts", F.array().cast("array<struct<hard:boolean,k:int,reach:bigint>>"))
    why = reached.select("record_key", _reasons(reached, state).alias("blocks")).unionByName(others.select("record_key", _reasons(others, state).alias("blocks")))
    out = marked.join(F.broadcast(cut(held)), "record_key", "left").join(why, "record_key", "left")
    route = F.when(F.col("ordinal").isNotNull(), "FETCH_NOW").when(F.col("hold_ordinal").isNotNull(), "HOLD_RESERVE").otherwise("CATALOG_ONLY")
    blocks = F.when(F.col("ordinal").isNull() & F.col("route").isin("FETCH_CANDIDATE", "RESERVE"), F.col("blocks"))
    return out.withColumns({"editorial_route": route, "blocks": blocks})
