"""Chains of road pieces: stitching at ends of degree two, corridors grown along the best continuation.

Pieces are rows (piece, seq, x, y); an end is (piece, end) with end `s` or `e`. Orders along chains come from pointer doubling on end states,
whose pointers carry the orientation, so a chain of n pieces takes log2(n) rounds; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .iterate import components, cut_dealt

c = F.col


def piece_ends(nodes: DataFrame) -> DataFrame:
    """piece, end, x, y and the unit direction (ox, oy) that leaves the piece there. Pieces of one node have no ends."""
    w = Window.partitionBy("piece").orderBy("seq", "x", "y")
    beside = nodes.select("piece", "x", "y", F.lag(F.struct("x", "y")).over(w).alias("before"), F.lead(F.struct("x", "y")).over(w).alias("after"))
    outer = beside.where(c("before").isNull() != c("after").isNull()).select("piece", F.when(c("before").isNull(), "s").otherwise("e").alias("end"), "x", "y", F.coalesce("before", "after").alias("q"))
    dx, dy = c("x") - c("q.x"), c("y") - c("q.y")
    length = F.sqrt(dx * dx + dy * dy)
    return outer.select("piece", "end", "x", "y", F.when(length > 0, dx / length).otherwise(0.0).alias("ox"), F.when(length > 0, dy / length).otherwise(0.0).alias("oy"))


def near_ends(ends: DataFrame, tol: float) -> DataFrame:
    """Ends of different pieces at most tol apart: piece, end, piece2, end2, d2 and align (1: straight on).

    Ends meet in grid cells of twice tol: one of a pair stands in its own cell, the other in the two by two cells that its reach touches.
    """
    size, reach = 2 * tol, tol * (1 + 1e-6)  # a little more than tol, for rounding
    touched = lambda x: F.explode(F.sequence(F.floor((c(x) - reach) / size), F.floor((c(x) + reach) / size)))
    own = ends.withColumns({"cx": F.floor(c("x") / size), "cy": F.floor(c("y") / size)})
    around = ends.withColumn("cx", touched("x")).withColumn("cy", touched("y"))
    other = own.select("cx", "cy", *(c(x).alias(f"{x}2") for x in ends.columns))
    d2 = F.pow(c("x") - c("x2"), F.lit(2)) + F.pow(c("y") - c("y2"), F.lit(2))
    met = around.join(other, ["cx", "cy"]).withColumn("d2", d2).where((c("piece") != c("piece2")) & (c("d2") <= tol * tol))
    return met.select("piece", "end", "piece2", "end2", "d2", F.round(-(c("ox") * c("ox2") + c("oy") * c("oy2")), 9).alias("align"))


def ranked_to_end(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(state, last, hops) of linked lists (state, to): the list's last state and how many steps lead there. Finished states leave the work.

    A ring never ends and is an error after most_rounds rounds of doubling.
    """
    work = cut_dealt(links.select("state", "to", F.lit(1).cast("long").alias("hops")).where("to is not null"), "list")
    done = cut_dealt(links.where("to is null").select("state", c("state").alias("last"), F.lit(0).cast("long").alias("hops")), "list-ends")
    for _ in range(most_rounds):
        beyond = work.select(c("state").alias("mid"), c("to").alias("next"), c("hops").alias("more"))
        ends = done.select(c("state").alias("mid2"), "last", c("hops").alias("left"))
        step = cut_dealt(work.join(beyond, c("to") == c("mid"), "left").join(ends, c("to") == c("mid2"), "left"), "list-step")
        done = cut_dealt(done.unionByName(step.where("last is not null").select("state", "last", (c("hops") + c("left")).alias("hops"))), "list-ends")
        work = cut_dealt(step.where("last is null").select("state", c("next").alias("to"), (c("hops") + c("more")).alias("hops")), "list")
        if not work.limit(1).count():
            return done
    raise RuntimeError(f"lists after {most_rounds} rounds of doubling aren't ranked: they hold a ring")


def _other(end):
    return F.when(end == "s", "e").otherwise("s")


def _compatible(a: str, b: str):
    """Two texts that don't contradict each other: equal, or one of them null or empty."""
    x, y = (F.coalesce(F.upper(F.trim(c(n))), F.lit("")) for n in (a, b))
    return (x == "") | (y == "") | (x == y)


def stitched(pieces: DataFrame, nodes: DataFrame, tol: float) -> DataFrame:
    """chain, pos and reversed of every piece: pieces whose ends have one partner each, each other, are one chain.

    pieces: piece, code, objekt, highway. A partner is an end within tol of a piece whose code and objekt don't contradict; ends of one piece count
    once. Both sides need the same highway. A chain is named after its smallest piece and runs from its end with the smaller piece; a ring begins with its smallest
    piece, as it is. Where a piece's code or objekt contradicts the last one that the chain had, the chain ends and a new one begins.
    """
    facts = pieces.select("piece", "code", "objekt", F.lower("highway").alias("highway"))
    met = near_ends(piece_ends(nodes.join(facts.select("piece"), "piece", "left_semi")), tol)
    two = facts.select(*(c(x).alias(f"{x}2") for x in facts.columns))
    met = met.join(two, "piece2").join(facts, "piece").where(_compatible("code", "code2") & _compatible("objekt", "objekt2"))
    one = met.groupBy("piece", "end").agg(F.count_distinct("piece2").alias("degree"), F.max(F.struct("piece2", "end2", F.col("highway").eqNullSafe(c("highway2")).alias("same"))).alias("p"))
    one = cut_dealt(one.where("degree = 1 and p.same").select("piece", "end", c("p.piece2").alias("piece2"), c("p.end2").alias("end2")), "partners")
    back = one.select(c("piece").alias("piece2"), c("end").alias("end2"), c("piece2").alias("piece"), c("end2").alias("end"))
    mutual = cut_dealt(one.join(back, ["piece", "end", "piece2", "end2"], "left_semi"), "mutual")

    groups = components(mutual.select(c("piece").alias("u"), c("piece2").alias("v")))
    label = cut_dealt(facts.join(groups, c("piece") == c("node"), "left").select("piece", F.coalesce("component", "piece").alias("group")), "groups")
    ring = label.join(mutual.groupBy("piece").count(), "piece", "left").groupBy("group").agg(F.min(F.coalesce("count", F.lit(0))).alias("least")).where("least = 2").select("group")
    opened = mutual.join(ring, (c("piece") == c("group")) & (c("end") == "s"), "left_anti").join(ring, (c("piece2") == c("group")) & (c("end2") == "s"), "left_anti")
    # a state is a piece entered at one end; it is left at the other one
    state = lambda piece, end: F.struct(piece.alias("piece"), end.alias("entry"))
    entries = label.select("piece", F.explode(F.array(F.lit("s"), F.lit("e"))).alias("entry")).withColumn("end", _other(c("entry")))
    links = entries.join(opened, ["piece", "end"], "left").select(state(c("piece"), c("entry")).alias("state"), F.when(c("piece2").isNotNull(), state(c("piece2"), c("end2"))).alias("to"))
    ranked = ranked_to_end(links).select("state.piece", "state.entry", "last", "hops").join(label, "piece")
    # both directions of a chain are lists; the one that ends at the larger piece is taken, forwards where both ends are one piece
    first = ranked.groupBy("group").agg(F.max("hops").alias("n"), F.max(F.struct(c("last.piece").alias("piece"), (c("last.entry") == "s").alias("forward"))).alias("far"))
    ring = ring.withColumn("ring", F.lit(True))
    taken = ranked.join(first, "group").join(ring, "group", "left").withColumn("pos", c("n") - c("hops"))
    ringed = taken.where("ring").select("group", "pos", "piece", "entry", "last").where((c("group") == c("piece")) & (c("pos") == 0) & (c("entry") == "s")).select("group", c("last").alias("to_last"))
    straight = taken.where("ring is null and last.piece = far.piece and (last.entry = 's') = far.forward")
    chosen = straight.select("group", "piece", "pos", "entry").unionByName(taken.where("ring").join(ringed, "group").where(c("last") == c("to_last")).select("group", "piece", "pos", "entry"))
    w = Window.partitionBy("group").orderBy("pos")
    text = lambda n: F.when(F.trim(c(n)) != "", F.upper(F.trim(c(n))))
    t = chosen.join(facts, "piece").withColumns({"a": text("code"), "b": text("objekt")})
    before = {f"{n}0": F.last(n, True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for n in ("a", "b")}
    broken = F.coalesce(c("a") != c("a0"), F.lit(False)) | F.coalesce(c("b") != c("b0"), F.lit(False))
    t = t.withColumns(before).withColumn("part", F.sum(broken.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("group", "part")
    return t.select(F.min("piece").over(own).alias("chain"), (c("pos") - F.min("pos").over(own)).alias("pos"), "piece", (c("entry") == "e").alias("reversed"))


def _walks(starts: DataFrame, pointers: DataFrame) -> DataFrame:
    """(group, side, k, from_piece, from_end, piece, entry): the states on the way from each start (group, side, piece, end, most), k from 1.

    pointers: piece, end -> piece2, end2. The known part of every way doubles each round, with pointers that leap as far, until ways end or
    come back to a piece; `most` bounds the steps.
    """
    leap = pointers.select("piece", "end", c("piece2").alias("piece_to"), _other(c("end2")).alias("end_to"))
    way = cut_dealt(starts.select("group", "side", "most", F.lit(0).cast("long").alias("k"), "piece", "end"), "way")
    span = 1
    while True:
        ahead = way.where(c("k") + span <= c("most")).join(leap, ["piece", "end"]).select("group", "side", "most", (c("k") + span).alias("k"), c("piece_to").alias("piece"), c("end_to").alias("end"))
        new = cut_dealt(way.unionByName(ahead), "way")
        turned = new.groupBy("group", "side", "piece").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group", "side").distinct()
        grown = new.where(c("k") >= span).select("group", "side").distinct().join(turned, ["group", "side"], "left_anti")
        way = new
        if not grown.limit(1).count():
            return way
        far = leap.select(c("piece").alias("piece_to"), c("end").alias("end_to"), c("piece_to").alias("p"), c("end_to").alias("e"))
        leap = cut_dealt(leap.join(far, ["piece_to", "end_to"]).select("piece", "end", c("p").alias("piece_to"), c("e").alias("end_to")), "leap")
        span *= 2


def corridors(pieces: DataFrame, nodes: DataFrame, tol: float = 1.0, trunk: str | None = None, start: int | None = None, forced: dict[int, int] | None = None, most_rounds: int = 500) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corridors of every code, their junctions and the forced successors that never applied.

    pieces: piece, code, length. Within a code a chain begins with the longest unused piece (the smaller id among equal ones; in the trunk's first chain
    with `start`, if it is there) and grows at its end, then at its beginning, in turns: by the unused piece with an end within tol that goes on
    straightest, then nearest, then of the larger id, then by its beginning. forced names the only successor of a piece, once. What is left begins chains again. Pieces without
    code are corridors by themselves.

    Connected pieces of a code are grown side by side. In a round every chain runs along best pointers among unused pieces until it would take a
    piece twice; steps from there on wait for the next round's pointers, so the result is that of one step after another.

    First table: code, corridor, kind (trunk, side, leftover or minor), part (number of the corridor within its code, from 0), pos, piece, reversed. Second: code,
    corridor, step, side, piece, chosen, align, candidates, override for steps with a choice or a forced successor. Third: piece, successor.
    """
    spark = pieces.sparkSession
    facts = pieces.select("piece", F.nullif(F.upper(F.trim("code")), F.lit("")).alias("code"), "length")
    coded = cut_dealt(facts.where("code is not null"), "coded")
    met = near_ends(piece_ends(nodes.join(coded.select("piece"), "piece", "left_semi")), tol)
    met = met.join(coded.select("piece", "code"), "piece").join(coded.select(c("piece").alias("piece2"), c("code").alias("code2")), "piece2").where("code = code2")
    met = cut_dealt(met.select("piece", "end", "piece2", "end2", F.round("d2", 9).alias("d2"), "align"), "candidates")
    label = components(met.select(c("piece").alias("u"), c("piece2").alias("v"))).select(c("node").alias("piece"), c("component").alias("group"))
    left = cut_dealt(coded.join(label, "piece", "left").select("piece", "code", "length", F.coalesce("group", "piece").alias("group")), "unused")
    asked = cut_dealt(spark.createDataFrame(list((forced or {}).items()), "piece long, successor long"), "forced")
    applied = cut_dealt(asked.select("piece").where("false"), "applied")
    chains = None  # group, number, first mover, and both ends
    taken = None  # every piece of a corridor so far
    moves = None
    for turn in range(most_rounds):
        busy = chains.select("group") if chains is not None else left.select("group").where("false")
        first = (c("code").eqNullSafe(F.lit(trunk.strip().upper() if trunk else None)) & c("piece").eqNullSafe(F.lit(start))).cast("int") if turn == 0 and start is not None else F.lit(0)
        order = F.struct(first.alias("a"), c("length").alias("b"), (-c("piece")).alias("p"))
        begun = left.join(busy, "group", "left_anti").groupBy("group").agg(F.first("code").alias("code"), F.max(order).alias("m"))
        begun = begun.select("group", "code", (-c("m.p")).alias("start"), c("m.b").alias("start_length"), c("m.a").alias("given"))
        begun = begun.select("group", "code", "start", "start_length", "given", F.lit(turn).alias("number"), F.lit("e").alias("mover"), c("start").alias("piece_e"), F.lit("e").alias("end_e"), c("start").alias("piece_s"), F.lit("s").alias("end_s"), F.lit(0).cast("long").alias("time"), F.lit(True).alias("fresh"))
        chains = cut_dealt(begun if chains is None else chains.unionByName(begun), "chains")
        if not chains.limit(1).count():
            break
        new = chains.where("fresh").select("group", "number", "code", "start", "start_length", "given", c("start").alias("piece"), F.lit(0).cast("long").alias("time"), F.lit("").alias("side"), F.lit("s").alias("entry"))
        taken = cut_dealt(new if taken is None else taken.unionByName(new), "taken")
        left = cut_dealt(left.join(new.select("piece"), "piece", "left_anti"), "unused")
        # the best way on from every end, among unused pieces
        open_ = met.join(left.select(c("piece").alias("piece2")), "piece2", "left_semi").join(asked.join(applied, "piece", "left_anti"), "piece", "left")
        best = F.max(F.struct("align", (-c("d2")).alias("near"), "piece2", "end2", c("successor").isNotNull().alias("override"))).alias("b")
        own = open_.where("successor is null or successor = piece2").groupBy("piece", "end").agg(best)
        own = cut_dealt(own.select("piece", "end", "b.piece2", "b.end2", "b.align", "b.override"), "pointers")
        free = open_.groupBy("piece", "end").agg(F.max(F.struct("align", (-c("d2")).alias("near"), "piece2", "end2")).alias("b")).select("piece", "end", "b.piece2", "b.end2", "b.align", F.lit(False).alias("override"))
        # a start piece with a forced successor: its end asks first; a single step each, then the next round knows what has applied
        pending = chains.where("fresh").join(asked.join(applied, "piece", "left_anti"), c("start") == c("piece")).select("group", c("piece").alias("forced_piece"))
        at_end = own.where("override and end = 'e'").select(c("piece").alias("done_piece"))
        released = pending.join(at_end, c("forced_piece") == c("done_piece")).select(c("forced_piece").alias("piece"), F.lit("s").alias("end"))
        pointers = own.join(released, ["piece", "end"], "left_anti").unionByName(free.join(released, ["piece", "end"], "left_semi"))
        pointers = cut_dealt(pointers, "pointers")
        steps = chains.join(pending.select("group", F.lit(1).cast("long").alias("most")), "group", "left").withColumn("most", F.coalesce("most", F.lit(1 << 40).cast("long")))
        both = steps.select("group", F.lit("e").alias("side"), c("piece_e").alias("piece"), c("end_e").alias("end"), "most").unionByName(steps.select("group", F.lit("s").alias("side"), c("piece_s").alias("piece"), c("end_s").alias("end"), "most"))
        way = _walks(both, pointers)
        mover = chains.select("group", "mover", "number", "time")
        timed = way.join(mover, "group").withColumn("at", c("time") + 2 * c("k") - (c("side") == c("mover")).cast("long"))
        visits = timed.where("k > 0").withColumn("visit", F.row_number().over(Window.partitionBy("group", "piece").orderBy("at")))
        stop = visits.where("visit > 1").groupBy("group").agg(F.min(F.struct("at", "side")).alias("stop")).hint("merge")
        visits = cut_dealt(visits.join(stop, "group", "left").where("stop is null or at < stop.at"), "visits")
        # what each step left from: the state before it on the same side
        source = way.select("group", "side", (c("k") + 1).alias("k"), c("piece").alias("from_piece"), c("end").alias("from_end"))
        made = visits.join(source, ["group", "side", "k"]).join(pointers.select(c("piece").alias("from_piece"), c("end").alias("from_end"), "align", "override"), ["from_piece", "from_end"])
        made = cut_dealt(made.select("group", "number", "side", "at", "from_piece", "from_end", "piece", _other(c("end")).alias("entry"), c("end").alias("exit"), "align", "override"), "made")
        moves = made.drop("exit") if moves is None else moves.unionByName(made.drop("exit"))
        start_of = chains.select("group", "number", "code", "start", "start_length", "given")
        taken = cut_dealt(taken.unionByName(made.join(start_of, ["group", "number"]).select("group", "number", "code", "start", "start_length", "given", "piece", c("at").alias("time"), "side", "entry")), "taken")
        left = cut_dealt(left.join(made.select("piece"), "piece", "left_anti"), "unused")
        applied = cut_dealt(applied.unionByName(made.where("override").select(c("from_piece").alias("piece"))), "applied")
        last = made.groupBy("group").agg(*(F.max_by(F.struct(c("piece").alias("piece"), c("exit").alias("end")), F.when(c("side") == s, c("at"))).alias(s) for s in ("e", "s")), F.max("at").alias("to"))
        halted = stop.select("group", c("stop.side").alias("again"), c("stop.at").alias("until"))
        grown = chains.join(last, "group", "left").join(halted, "group", "left").join(pending.select("group", F.lit(True).alias("waits")), "group", "left")
        # a chain that met itself goes on with the side that did; one whose ends found nothing is complete
        grown = grown.where("again is not null or (waits and to is not null)")
        ends = [F.coalesce(c(f"{s}.{x}"), c(f"{x}_{s}")).alias(f"{x}_{s}") for s in ("e", "s") for x in ("piece", "end")]
        chains = grown.select("group", "code", "start", "start_length", "given", "number", F.coalesce("again", "mover").alias("mover"), *ends, F.coalesce(c("until") - 1, c("time") + 2).alias("time"), F.lit(False).alias("fresh"))
        chains = cut_dealt(chains.select("group", "code", "start", "start_length", "given", "number", "mover", "piece_e", "end_e", "piece_s", "end_s", "time", "fresh"), "chains")
    else:
        raise RuntimeError(f"corridors after {most_rounds} rounds aren't complete")

    if taken is None:
        taken = cut_dealt(left.select("group", F.lit(0).alias("number"), "code", c("piece").alias("start"), c("length").alias("start_length"), F.lit(0).alias("given"), "piece", F.lit(0).cast("long").alias("time"), F.lit("").alias("side"), F.lit("s").alias("entry")), "taken")
    heads = taken.where("side = ''").select("group", "number", "code", "start", "start_length", "given")
    heads = heads.withColumn("part", F.row_number().over(Window.partitionBy("code").orderBy(F.desc("given"), F.desc("start_length"), "start")) - 1)
    kind = F.when(c("part") > 0, "leftover").when(c("code").eqNullSafe(F.lit(trunk.strip().upper() if trunk else None)), "trunk").otherwise("side")
    name = F.concat(F.when(c("kind") == "trunk", "trunk_").otherwise(""), c("code"), F.when(c("kind") == "leftover", F.concat(F.lit("_leftover_"), c("part").cast("string"))).otherwise(""))
    heads = cut_dealt(heads.withColumn("kind", kind).withColumn("corridor", name), "corridors")
    place = F.when(c("side") == "s", -c("time")).otherwise(c("time"))
    rows = taken.select("group", "number", "piece", place.alias("place"), F.when(c("side") == "s", c("entry") == "s").otherwise(c("entry") == "e").alias("reversed")).join(heads, ["group", "number"])
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("group", "number").orderBy("place")) - 1).select("code", "corridor", "kind", "part", "pos", "piece", "reversed")
    minor = facts.where("code is null").select("code", F.concat(F.lit("minor_"), c("piece").cast("string")).alias("corridor"), F.lit("minor").alias("kind"), F.lit(0).alias("part"), F.lit(0).alias("pos"), "piece", F.lit(False).alias("reversed"))
    out = cut_dealt(rows.unionByName(minor), "corridor-pieces")

    if moves is None:
        logged = out.select("code", "corridor", F.lit(0).alias("step"), F.lit("").alias("side"), "piece", c("piece").alias("chosen"), F.lit(0.0).alias("align"), F.lit(0).cast("long").alias("candidates"), F.lit(False).alias("override")).where("false")
    else:
        moved = moves.join(heads.select("group", "number", "code", "corridor", "part"), ["group", "number"])
        when = taken.select(c("piece").alias("piece2"), c("number").alias("number2"), c("time").alias("time2"))
        seen = moved.alias("m").join(met.select(c("piece").alias("from_piece"), c("end").alias("from_end"), "piece2"), ["from_piece", "from_end"]).join(when, "piece2")
        still = (c("number2") > c("number")) | ((c("number2") == c("number")) & (c("time2") >= c("at")))
        seen = seen.where(still).groupBy("group", "number", "at").agg(F.count(F.lit(1)).alias("candidates"))
        logged = moved.join(seen, ["group", "number", "at"]).where("candidates > 1 or override")
        step = F.row_number().over(Window.partitionBy("group", "number").orderBy("at"))
        logged = logged.withColumn("step", step).select("code", "corridor", "step", "side", c("from_piece").alias("piece"), c("piece").alias("chosen"), "align", "candidates", "override")
    return out, logged, asked.join(applied, "piece", "left_anti")
