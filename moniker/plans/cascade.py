"""First hit by priority over a chain of dictionary lookups.

What a word resolves to depends on the word alone, so the chain runs on the
distinct words and its result is joined back to the mentions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.functions import cas_key, formula_key, is_rubbish
from moniker.operators.lookup import lookup_keys, lookup_words
from moniker.operators.skew import HOT_FLOOR, spread_join, top_keys
from moniker.sources.scratch import packed as materialise

SUBSTANCE = "substance"
ENTITY = "entity"

# A word with so many mentions or more, and at least 1/FREQUENT_WORDS of them all, meets its
# answer without a shuffle. So there are at most FREQUENT_WORDS such words, and those with
# longer answers are left to the join, which bounds what is broadcast.
FREQUENT_FLOOR = 1_000
FREQUENT_WORDS = 50_000
ANSWER_CHARS = 256


@dataclass(frozen=True)
class Lookup:
    """A step that looks words up in ``dictionary`` ``(key, ids)``.

    By default the word is the key. Else the key comes from one of: ``key``, a
    column expression of the word; ``names``, a table ``(name, key)``;
    ``resolver``, which takes the names of a batch and returns one key or None
    for each. A resolver is given only words that no earlier step has resolved. With a
    path as ``quarantine`` it may fail on some names: these are written there as
    ``(word_orig, error)``, stay without a key, and the others go on.
    """

    name: str
    dictionary: DataFrame
    kind: str = SUBSTANCE
    key: Callable[[Column], Column] | None = None
    names: DataFrame | None = None
    resolver: Callable[[list[str]], Iterable[str | None]] | None = None
    quarantine: str | None = None


@dataclass(frozen=True)
class Discard:
    """A step that drops words for which ``flag`` is true.

    With ``resolved=False`` words that an earlier step has resolved stay.
    """

    name: str
    flag: Callable[[Column], Column]
    resolved: bool = True


def standard_chain(
    names: DataFrame,
    cas: DataFrame,
    formulas: DataFrame,
    inchikeys: DataFrame,
    entities: DataFrame,
    name_to_inchikey: DataFrame | None = None,
    resolver: Callable[[list[str]], Iterable[str | None]] | None = None,
    rubbish_scope: str = "all",
    spare_cas: bool = True,
) -> list[Lookup | Discard]:
    """Name, rubbish filter, CAS number, formula, InChIKey, entity.

    ``rubbish_scope="unresolved"`` keeps noise words that are dictionary names.
    The rule for digits fits every CAS number; ``spare_cas=False`` lets it drop
    them too, which leaves the CAS lookup without a hit.
    """

    def rubbish(word: Column) -> Column:
        return is_rubbish(word) & cas_key(word).isNull() if spare_cas else is_rubbish(word)

    return [
        Lookup("name", names),
        Discard("rubbish", rubbish, resolved=rubbish_scope == "all"),
        Lookup("cas", cas, key=cas_key),
        Lookup("formula", formulas, key=formula_key),
        Lookup("inchikey", inchikeys, names=name_to_inchikey, resolver=resolver),
        Lookup("entity", entities, kind=ENTITY),
    ]


def _key_column(step: Lookup) -> str:
    return f"key_{step.name}"


def _flagged(chain: Sequence[Lookup | Discard], resolved: bool) -> Column:
    flags = [step.flag(F.col("word_orig")) for step in chain if isinstance(step, Discard) and step.resolved == resolved]
    return reduce(Column.__or__, flags, F.lit(False))


def _dropped(chain: Sequence[Lookup | Discard]) -> Column:
    """Whether an unconditional discard step drops the word.

    Such a step drops a word wherever it stands in the chain.
    """
    return _flagged(chain, True)


def distinct_words(documents: DataFrame, chain: Sequence[Lookup | Discard] = ()) -> DataFrame:
    """Distinct words of nested documents: how often, whether dropped or doubtful, with which keys.

    A doubtful word is dropped unless a step before the one that flags it resolves it.

    All that depends on the word is worked out here, after the aggregation, and
    written once for all steps. Without the write every step would push its own
    filter below the aggregation and scan all mentions again. Of the mention
    lists only the words are read. A list without a word gives a null, which goes with
    the null words: without ``outer`` Spark asks the size of each list first, and makes
    lists that are derived on the way once more for it.
    """
    counted = (
        documents.select(F.explode_outer("infer_list.word_orig").alias("word_orig"))
        .where(F.col("word_orig").isNotNull())
        .groupBy("word_orig")
        .agg(F.count(F.lit(1)).alias("n_mentions"))
    )
    derived = [step for step in chain if isinstance(step, Lookup) and step.key is not None]
    keys = [step.key(F.col("word_orig")).alias(_key_column(step)) for step in derived]
    flags = [_dropped(chain).alias("dropped"), _flagged(chain, False).alias("doubtful")]
    return materialise(counted.select("*", *flags, *keys), "words")


def kept_words(words: DataFrame) -> DataFrame:
    return words.where(~F.col("dropped"))


def answered_words(words: DataFrame, resolution: DataFrame) -> DataFrame:
    """``(word_orig, ids, stage, kind)`` of every word that no step drops, resolved or not.

    Steps after the one that flags a word do not see it, so a doubtful word with a
    hit has it from before.
    """
    answers = kept_words(words).select("word_orig", "doubtful").join(resolution, "word_orig", "left")
    return answers.where(~F.col("doubtful") | F.col("stage").isNotNull()).drop("doubtful")


def _isolated(resolver: Callable[[list[str]], Iterable[str | None]], names: list[str], attempts: int) -> list[tuple]:
    """(key, attempts, error) of each name. A batch that fails is halved until single names are left that fail."""
    try:
        keys = list(resolver(names))
        if len(keys) != len(names):
            raise ValueError(f"{len(keys)} answers for {len(names)} names")
        return [(key, attempts, None) for key in keys]
    except Exception as error:  # whatever a user's function raises
        if len(names) == 1:
            return [(None, attempts, f"{type(error).__name__}: {error}")]
        half = len(names) // 2
        return _isolated(resolver, names[:half], attempts + 1) + _isolated(resolver, names[half:], attempts + 1)


def resolver_answers(
    words: DataFrame,
    resolver: Callable[[list[str]], Iterable[str | None]],
    resolved: DataFrame | None = None,
) -> DataFrame:
    """``(word_orig, key, attempts, error)``: a user resolver run over the distinct words that are not ``resolved`` yet.

    Names on which it raises do not stop the others: ``error`` says what was raised, and
    ``attempts`` how many calls a name was part of. Every key travels beside its name, so a
    resolver cannot shift the answers; one that gives too few or too many counts as failing.
    """

    def batches(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for frame in frames:
            names = frame["word_orig"].tolist()
            told = pd.DataFrame(_isolated(resolver, names, 1) if names else [], columns=["key", "attempts", "error"], dtype=object)
            yield told.assign(word_orig=names)[["word_orig", "key", "attempts", "error"]]

    todo = words if resolved is None else words.join(resolved, "word_orig", "left_anti")
    return todo.select("word_orig").mapInPandas(batches, "word_orig string, key string, attempts int, error string")


def failed_names(answers: DataFrame) -> DataFrame:
    """The quarantine: ``(word_orig, error)`` of names that a resolver could not take."""
    return answers.where(F.col("error").isNotNull()).select("word_orig", "error")


def resolver_keys(
    words: DataFrame,
    resolver: Callable[[list[str]], Iterable[str | None]],
    resolved: DataFrame | None = None,
) -> DataFrame:
    """``(word_orig, key)`` of the names that a resolver has a key for; an error of the resolver ends the job.

    Every key travels beside its name, so a resolver cannot shift the answers.
    """

    def batches(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for frame in frames:
            names = frame["word_orig"].tolist()
            yield pd.DataFrame({"word_orig": names, "key": list(resolver(names))}, dtype=object)

    todo = words if resolved is None else words.join(resolved, "word_orig", "left_anti")
    keyed = todo.select("word_orig").mapInPandas(batches, "word_orig string, key string")
    return keyed.where(F.col("key").isNotNull())


def named_keys(words: DataFrame, names: DataFrame) -> DataFrame:
    """``(word_orig, key)`` of the words that ``names`` ``(name, key)`` has.

    Words come first: only what they hit goes on to the dictionary of the keys.
    """
    keyed = names.withColumnRenamed("name", "word_orig")
    return words.select("word_orig").join(keyed, "word_orig").select("word_orig", "key")


def _hits(words: DataFrame, step: Lookup, earlier: DataFrame | None) -> DataFrame:
    if step.key is not None:
        return lookup_keys(words.withColumnRenamed(_key_column(step), "key"), step.dictionary)
    if step.names is not None:
        return lookup_keys(materialise(named_keys(words, step.names), "keys"), step.dictionary)
    if step.resolver is not None:
        # Written down: the key skew is measured before the join, and a costly
        # resolver must not run twice.
        if step.quarantine is None:
            return lookup_keys(materialise(resolver_keys(words, step.resolver, earlier), "keys"), step.dictionary)
        answers = materialise(resolver_answers(words, step.resolver, earlier), "keys")
        failed_names(answers).write.mode("overwrite").parquet(step.quarantine)
        return lookup_keys(answers.where(F.col("key").isNotNull()), step.dictionary)
    return lookup_words(words, step.dictionary)


def resolve_words(words: DataFrame, chain: Sequence[Lookup | Discard]) -> DataFrame:
    """``(word_orig, ids, stage, kind)`` of every word that a step resolves.

    ``words`` are the ``distinct_words`` for the same chain.
    """
    live = kept_words(words)
    hits: list[DataFrame] = []
    for priority, step in enumerate(chain):
        if isinstance(step, Discard):
            if not step.resolved:
                live = live.where(~step.flag(F.col("word_orig")))
            continue
        earlier = None
        if step.resolver is not None and hits:
            hits = [materialise(reduce(DataFrame.unionByName, hits), "hits")]
            earlier = hits[0]
        found = _hits(live, step, earlier)
        rank = F.struct(
            F.lit(priority).alias("priority"), "ids", F.lit(step.name).alias("stage"), F.lit(step.kind).alias("kind")
        )
        hits.append(found.select("word_orig", rank.alias("hit")))
    first = reduce(DataFrame.unionByName, hits).groupBy("word_orig").agg(F.min("hit").alias("hit"))
    return first.select("word_orig", "hit.ids", "hit.stage", "hit.kind")


def known_answers(words: DataFrame, earlier: DataFrame) -> DataFrame:
    """What ``earlier`` ``(word_orig, ids, stage, kind)`` says of ``words``."""
    return earlier.select("word_orig", "ids", "stage", "kind").join(words.select("word_orig"), "word_orig", "left_semi")


def fresh_answers(words: DataFrame, chain: Sequence[Lookup | Discard], earlier: DataFrame) -> DataFrame:
    """``answered_words`` of those ``words`` of which ``earlier`` says nothing."""
    fresh = materialise(words.join(earlier.select("word_orig"), "word_orig", "left_anti"), "words")
    return answered_words(fresh, resolve_words(fresh, chain))


def extend_resolution(words: DataFrame, chain: Sequence[Lookup | Discard], earlier: DataFrame) -> DataFrame:
    """``answered_words`` of ``words``, of which ``earlier`` has some from a former job with the same chain.

    Only words that ``earlier`` ``(word_orig, ids, stage, kind)`` does not have are
    looked up; those it has and ``words`` does not are left out.
    """
    return known_answers(words, earlier).unionByName(fresh_answers(words, chain, earlier))


def frequent_answers(words: DataFrame, answers: DataFrame) -> DataFrame:
    """``answers`` of frequent words; ``answered`` is null for those without one."""
    total = words.agg(F.coalesce(F.sum("n_mentions"), F.lit(0))).first()[0]
    often = words.where(F.col("n_mentions") >= max(FREQUENT_FLOOR, total // FREQUENT_WORDS)).select("word_orig")
    told = often.join(answers.withColumn("answered", F.lit(True)), "word_orig", "left")
    ids = F.length(F.array_join("ids", "")) + 8 * F.size("ids")
    return materialise(told.where(F.length("word_orig") + F.coalesce(ids, F.lit(0)) <= ANSWER_CHARS), "frequent")


def tag_mentions(
    mentions: DataFrame,
    words: DataFrame,
    resolution: DataFrame,
    section: str,
    unresolved: bool = False,
    hot_floor: int = HOT_FLOOR,
    chain: Sequence[Lookup | Discard] = (),
) -> DataFrame:
    """Mentions with what their word resolves to, stamped with the document section.

    ``unresolved=True`` also keeps mentions without a hit. Answers of frequent words are
    broadcast, as far as they are short, so that only mentions of the others are shuffled. Of
    these a word with a large share of all mentions is spread over many tasks; ``words`` has
    the counts that tell. With the ``chain``, mentions that it drops whatever they resolve to
    are left out before the shuffle.
    """
    answers = materialise(answered_words(words, resolution) if unresolved else resolution, "answers")
    mentions = mentions.where(F.col("word_orig").isNotNull())
    frequent = frequent_answers(words, answers)
    if frequent.isEmpty():
        return _tag_rest(mentions.where(~_dropped(chain)), words, answers, hot_floor).withColumn("section", F.lit(section))
    known = frequent.select("word_orig", F.lit(True).alias("known"))
    # One expression of both sides, so that rules are tried on words that are not known only.
    others = mentions.join(F.broadcast(known), "word_orig", "left")
    others = others.where(F.when(F.col("known"), False).otherwise(~_dropped(chain))).drop("known")
    rest = words.join(F.broadcast(known), "word_orig", "left_anti")
    found = frequent.where(F.col("answered") & ~_dropped(chain)).drop("answered")
    tagged = _tag_rest(others, rest, answers, hot_floor).unionByName(mentions.join(F.broadcast(found), "word_orig"))
    return tagged.withColumn("section", F.lit(section))


def _tag_rest(mentions: DataFrame, words: DataFrame, answers: DataFrame, hot_floor: int) -> DataFrame:
    """Mentions with their answers by a join that spreads hot ones of ``words``."""
    hot = top_keys(kept_words(words), "word_orig", "n_mentions", floor=hot_floor)
    identity = [c for c in mentions.columns if c != "word_orig"]
    return spread_join(mentions, answers, "word_orig", hot, spread_by=identity)
