"""Answers for time on ice, pairs, combinations and metrics."""

from oracle.base import PBP, ROSTER, ice

NAMED_LAST = """names as (
 select gameId, player1Id, max_by(fullName, o) as name, max_by(eventTeam, o) as team from (
  select p.gameId, p.player1Id, r.fullName, p.eventTeam,
   (cast(p.elapsedTime as bigint)*2 + case when p.Event='ON' then 1 else 0 end) * 1000000000 + p.seq as o
  from pbp p left join roster r on r.playerId=p.player1Id and r.gameId=p.gameId where p.Event in ('ON','OFF')) group by 1,2)"""

# plays with the second whose ice they see and their credit from the view of team `v`
CREDIT = """
plays as (select p.gameId, p.elapsedTime as t, p.Event, p.eventTeam as et, coalesce(p.xG,0) as xg, v.team as team
 from pbp p, (values ('AAA'),('BBB')) v(team) where Event in ('SHOT','GOAL','MISS','BLOCK','PENL','GIVE','TAKE')),
credit as (select gameId, t, team,
  case when Event in ('SHOT','GOAL','MISS') and et=team or Event='BLOCK' and et<>team then 1 else 0 end as CF,
  case when Event in ('SHOT','GOAL','MISS') and et<>team or Event='BLOCK' and et=team then 1 else 0 end as CA,
  case when Event in ('SHOT','GOAL','MISS') and et=team then 1 else 0 end as FF,
  case when Event in ('SHOT','GOAL','MISS') and et<>team then 1 else 0 end as FA,
  case when Event in ('SHOT','GOAL') and et=team then 1 else 0 end as SF,
  case when Event in ('SHOT','GOAL') and et<>team then 1 else 0 end as SA,
  case when Event='GOAL' and et=team then 1 else 0 end as GF,
  case when Event='GOAL' and et<>team then 1 else 0 end as GA,
  case when Event in ('SHOT','GOAL','MISS') and et=team then xg else 0 end as xG,
  case when Event in ('SHOT','GOAL','MISS') and et<>team then xg else 0 end as xGA,
  case when Event='PENL' and et<>team then 1 else 0 end as PF,
  case when Event='PENL' and et=team then 1 else 0 end as PA,
  case when Event='GIVE' and et=team then 1 else 0 end as GIVE_for,
  case when Event='GIVE' and et<>team then 1 else 0 end as GIVE_against,
  case when Event='TAKE' and et=team then 1 else 0 end as TAKE_for,
  case when Event='TAKE' and et<>team then 1 else 0 end as TAKE_against
 from plays)"""

COUNTS = ["CF", "CA", "FF", "FA", "SF", "SA", "GF", "GA"]
XG = ["xG", "xGA"]
PEN = ["PF", "PA"]
PUCK = ["GIVE_for", "GIVE_against", "TAKE_for", "TAKE_against"]


def _stat_sums(names) -> str:
    out = []
    for n in names:
        if n in XG:
            out.append(f"sum({n}) as {n}")
        else:
            out.append(f"cast(sum({n}) as bigint) as {n}")
    return ", ".join(out)


def _stat_out(names, a="k") -> str:
    out = []
    for n in names:
        if n in XG:
            out.append(f"round(coalesce({a}.{n},0),6) as {n}")
        else:
            out.append(f"coalesce({a}.{n},0) as {n}")
    return ", ".join(out)


def _per60(names, sec="t.seconds", a="k") -> str:
    return ", ".join(f"round(coalesce({a}.{n},0)/({sec}/3600.0),6) as {n}_per60" for n in names)


def _combo_cte(n: int, name: str, goalies: bool) -> str:
    """n-subsets of each side per second, from an n-way self join in id order."""
    g = "" if goalies else "and {a}.isGoalie=0"
    frm = "ice a1"
    for i in range(2, n + 1):
        frm += (f" join ice a{i} on a{i}.gameId=a1.gameId and a{i}.s=a1.s and a{i}.eventTeam=a1.eventTeam"
                f" and a{i}.player1Id>a{i-1}.player1Id")
    where = " ".join(g.format(a=f"a{i}") for i in range(1, n + 1))
    cols = ", ".join(f"a{i}.player1Id as {name}{i}" for i in range(1, n + 1))
    return f"{name} as (select a1.gameId, a1.s, a1.eventTeam as team, {cols} from {frm} where true {where})"


def _ids(prefix: str, n: int, a: str = "") -> str:
    return ", ".join(f"{a}{prefix}{i}" for i in range(1, n + 1))


def combo_toi(n: int, m: int, min_seconds: int = 1, goalies_team=False, goalies_opp=False, player=False) -> str:
    ctes = [ice(), _combo_cte(n, "p", goalies_team)]
    join, oppsel, oppgrp = "", "", ""
    if m:
        ctes.append(_combo_cte(m, "o", goalies_opp))
        join = "join o on o.gameId=p.gameId and o.s=p.s and o.team<>p.team"
        oppsel = ", " + ", ".join(f"o{i} as opp{i}_player1Id" for i in range(1, m + 1))
        oppgrp = ", " + _ids("o", m)
    first = "player_player1Id" if player else "p1_player1Id"
    own = ", ".join(f"p{i} as {first if i == 1 else f'p{i}_player1Id'}" for i in range(1, n + 1))
    return f"""with {', '.join(ctes)}
select p.gameId, p.team, {own}{oppsel}, case when p.team='AAA' then l12 else l21 end as Strength,
 round(count(*)/60.0,6) as TOI
from p join lab on lab.gameId=p.gameId and lab.s=p.s {join}
group by p.gameId, p.team, {_ids('p', n)}{oppgrp}, case when p.team='AAA' then l12 else l21 end
having count(*) >= {min_seconds}"""


def combo_stats(n: int, m: int, min_toi: int, both: bool) -> str:
    """Combination stats; names as last seen (one team) or from the roster (both)."""
    names = [*COUNTS, *XG, *PEN]
    ctes = [ice(), ROSTER, NAMED_LAST, CREDIT, _combo_cte(n, "p", False)]
    osel, ojoin = "", ""
    if m:
        ctes.append(_combo_cte(m, "o", False))
        osel = ", " + _ids("o", m, "o.")
        ojoin = "join o on o.gameId=p.gameId and o.s=p.s and o.team<>p.team"
    keys = ["gameId", "team", *[f"p{i}" for i in range(1, n + 1)], *[f"o{i}" for i in range(1, m + 1)]]
    ctes.append(f"c as (select p.gameId, p.s, p.team, {_ids('p', n, 'p.')}{osel}, l12 as strength"
                f" from p join lab on lab.gameId=p.gameId and lab.s=p.s {ojoin})")
    k = ", ".join(keys)
    ctes.append(f"t as (select {k}, strength, count(*) as seconds from c group by all having count(*)>={min_toi})")
    ctes.append(f"k as (select {', '.join('c.'+x for x in keys)}, c.strength, {_stat_sums(names)} from c"
                f" join credit q on q.gameId=c.gameId and q.team=c.team and q.t=c.s+1 group by all)")
    on = " and ".join(f"k.{x}=t.{x}" for x in [*keys, "strength"])

    def nm(col):
        if both:
            return f"(select fullName from roster r where r.playerId=t.{col} and r.gameId=t.gameId)"
        return f"(select name from names r where r.player1Id=t.{col} and r.gameId=t.gameId)"

    team_combo = " || ' / ' || ".join(f"coalesce({nm(f'p{i}')}, cast(t.p{i} as varchar))" for i in range(1, n + 1))
    opp_combo = " || ' / ' || ".join(f"coalesce({nm(f'o{i}')}, cast(t.o{i} as varchar))" for i in range(1, m + 1)) if m else "'ANY'"
    extra = ""
    if both:
        def pos(col):
            return (f"(select case when positionCode in ('F','D','G') then positionCode end from roster r"
                    f" where r.playerId=t.{col} and r.gameId=t.gameId)")

        def sig(prefix, count):
            if not count:
                return "''"
            lst = "[" + ", ".join(pos(f"{prefix}{i}") for i in range(1, count + 1)) + "]"
            parts = [f"case when len(list_filter({lst}, lambda x: x='{q}'))>0 then"
                     f" len(list_filter({lst}, lambda x: x='{q}')) || '{q}' else '' end" for q in "FDG"]
            return " || ".join(parts)

        extra += f", {sig('p', n)} as team_combo_pos, {sig('o', m)} as opp_combo_pos"
        for prefix, out, count in (("p", "player", n), ("o", "oppPlayer", m)):
            for i in range(1, count + 1):
                extra += (f", t.{prefix}{i} as {out}{i}Id, {nm(f'{prefix}{i}')} as {out}{i}Name,"
                          f" {pos(f'{prefix}{i}')} as {out}{i}Position,"
                          f" (select sweaterNumber from roster r where r.playerId=t.{prefix}{i} and r.gameId=t.gameId) as {out}{i}Number,"
                          f" cast(null as varchar) as {out}{i}Headshot")
        extra += ", " + " || ',' || ".join(f"cast(t.p{i} as varchar)" for i in range(1, n + 1)) + " as team_combo_ids"
        extra += (", " + " || ',' || ".join(f"cast(t.o{i} as varchar)" for i in range(1, m + 1)) if m else ", cast(null as varchar)") + " as opp_combo_ids"
    where = "" if both else "where t.team='AAA'"
    return f"""with {', '.join(ctes)}
select t.gameId, t.team, case when t.team='AAA' then 'BBB' else 'AAA' end as opp, {team_combo} as team_combo,
 {opp_combo} as opp_combo{extra}, t.strength, cast(t.seconds as double) as seconds, round(t.seconds/60.0,6) as minutes,
 {_stat_out(names)}, {_per60(names)}
from t left join k on {on} {where}"""


def combo_shots() -> str:
    fam = [("Shots", "SF", "SA"), ("Fenwick", "FF", "FA"), ("Corsi", "CF", "CA")]
    out = []
    for f, a, b in fam:
        out += [f"{a} as \"{f}For\"", f"{b} as \"{f}Against\"", f"{a}-{b} as \"{f}Differential\"",
                f"round(case when {a}+{b}>0 then {a}/cast({a}+{b} as double) end,6) as \"{f}For%\""]
        out += [f"round({a}*60.0/TOI,6) as \"{f}For/60\"", f"round({b}*60.0/TOI,6) as \"{f}Against/60\"",
                f"round(({a}-{b})*60.0/TOI,6) as \"{f}Differential/60\""]
    names = ["CF", "CA", "FF", "FA", "SF", "SA"]
    return f"""with {ice()}, {CREDIT}, {_combo_cte(2, 'p', False)},
last_ as (select gameId, max(s) as m from ice group by 1),
c as (select p.gameId, p.s, p.team, p1, p2, case when p.team='AAA' then l12 else l21 end as Strength
      from p join lab on lab.gameId=p.gameId and lab.s=p.s),
q as (select credit.*, greatest(0, least(t, m)) as at_ from credit join last_ using (gameId)),
k as (select c.gameId, c.team, p1, p2, Strength, {_stat_sums(names)} from c
      join q on q.gameId=c.gameId and q.team=c.team and q.at_=c.s group by all having sum(CF)+sum(CA)>0),
t as (select gameId, team, p1, p2, Strength, count(*)/60.0 as TOI from c group by all)
select gameId, team, p1 as p1_player1Id, p2 as p2_player1Id, Strength, round(TOI,6) as TOI, {', '.join(out)}
from k left join t using (gameId, team, p1, p2, Strength)"""


SQL = {
    "player_intervals": f"""with {PBP},
 gend as (select gameId, max(elapsedTime) as e from pbp group by 1),
 st as (select gameId, eventTeam, isGoalie, player1Id, elapsedTime as t,
         max(case when Event='ON' then 1 else 0 end) as on_ from pbp where Event in ('ON','OFF') group by all),
 starts as (select * from st a where on_=1 and not coalesce((select arg_max(b.on_, b.t) from st b
   where b.gameId=a.gameId and b.eventTeam=a.eventTeam and b.isGoalie=a.isGoalie and b.player1Id=a.player1Id
    and b.t<a.t),0)=1)
 select a.gameId, a.eventTeam, a.isGoalie, a.player1Id, a.t as t_on,
  coalesce((select min(b.t) from st b where b.gameId=a.gameId and b.eventTeam=a.eventTeam and
    b.isGoalie=a.isGoalie and b.player1Id=a.player1Id and b.t>a.t and b.on_=0), e) as t_off
 from starts a join gend using (gameId)
 where coalesce((select min(b.t) from st b where b.gameId=a.gameId and b.eventTeam=a.eventTeam and
    b.isGoalie=a.isGoalie and b.player1Id=a.player1Id and b.t>a.t and b.on_=0), e) > a.t""",
    # expanded to seconds by both engines: pieces may be cut differently, seconds may not
    "strength_segments_set": f"""with {ice()}
 select gameId, s as second, s1 as skaters1, s2 as skaters2, g1 as goalies1, g2 as goalies2, l12 as strength
 from lab""",
    "on_ice_at": f"""with {ice()},
 l as (select gameId, s,
   string_agg(cast(player1Id as varchar), ',' order by player1Id) filter (eventTeam='AAA' and isGoalie=0) as a,
   string_agg(cast(player1Id as varchar), ',' order by player1Id) filter (eventTeam='BBB' and isGoalie=0) as b,
   string_agg(cast(player1Id as varchar), ',' order by player1Id) filter (eventTeam='AAA' and isGoalie=1) as c,
   string_agg(cast(player1Id as varchar), ',' order by player1Id) filter (eventTeam='BBB' and isGoalie=1) as d
  from ice group by 1,2)
 select lab.gameId, lab.s as second, l12 as strength, coalesce(a,'') as s1_ids, coalesce(b,'') as s2_ids,
  coalesce(c,'') as g1_ids, coalesce(d,'') as g2_ids
 from lab left join l on l.gameId=lab.gameId and l.s=lab.s""",
    "toi_by_strength": f"""with {ice(True)}
 select gameId, l12 as strength, count(*) as seconds, round(count(*)/60.0,6) as minutes from lab group by 1,2""",
    "toi_by_player_strength": f"""with {ice(True)}, {ROSTER}, {NAMED_LAST}
 select ice.gameId, ice.player1Id, name as player1Name, team as eventTeam, l12 as strength, count(*) as seconds,
  round(count(*)/60.0,6) as minutes
 from ice join lab on lab.gameId=ice.gameId and lab.s=ice.s
 join names on names.gameId=ice.gameId and names.player1Id=ice.player1Id group by 1,2,3,4,5""",
    "toi_dense": f"""with {ice()},
 own as (select ice.gameId, ice.eventTeam, ice.isGoalie, ice.player1Id,
   case when ice.eventTeam='AAA' then l12 else l21 end as Strength
  from ice join lab on lab.gameId=ice.gameId and lab.s=ice.s),
 pl as (select distinct gameId, eventTeam, isGoalie, player1Id from own),
 lb as (select distinct gameId, Strength from own)
 select pl.gameId, pl.player1Id, pl.eventTeam, pl.isGoalie, lb.Strength, round(count(own.player1Id)/60.0,6) as time_on_ice
 from pl join lb on lb.gameId=pl.gameId left join own on own.gameId=pl.gameId and own.eventTeam=pl.eventTeam
  and own.isGoalie=pl.isGoalie and own.player1Id=pl.player1Id and own.Strength=lb.Strength
 group by 1,2,3,4,5""",
    "strength_by_second_full": f"""with {ice()}, last_ as (select gameId, max(s) as m from ice group by 1)
 select lab.gameId, s as second, s1 as home_sktrs_count, s2 as away_sktrs_count, g1 as home_goalies_count,
  g2 as away_goalies_count, left_ as home_strength, right_ as away_strength, l12 as team_str_home, l21 as team_str_away
 from lab join last_ on last_.gameId=lab.gameId and s<=m""",
    "shared_toi_teammates": f"""with {ice()}
 select a.gameId, a.eventTeam, a.player1Id, b.player1Id as tm_player1Id,
  case when a.eventTeam='AAA' then l12 else l21 end as Strength, round(count(*)/60.0,6) as TOI
 from ice a join ice b on a.gameId=b.gameId and a.s=b.s and a.eventTeam=b.eventTeam and a.player1Id<>b.player1Id
 join lab on lab.gameId=a.gameId and lab.s=a.s group by 1,2,3,4,5""",
    "shared_toi_opponents": f"""with {ice()}
 select a.gameId, a.eventTeam, a.player1Id, b.player1Id as opp_player1Id,
  case when a.eventTeam='AAA' then l12 else l21 end as playerStrength,
  case when a.eventTeam='AAA' then l21 else l12 end as oppStrength, round(count(*)/60.0,6) as TOI
 from ice a join ice b on a.gameId=b.gameId and a.s=b.s and a.eventTeam<>b.eventTeam
 join lab on lab.gameId=a.gameId and lab.s=a.s group by 1,2,3,4,5,6""",
    "combos_teammates": combo_toi(3, 0),
    "combos_opponents": combo_toi(1, 2, goalies_team=True, player=True),
    "combo_toi": combo_toi(2, 1),
    "combo_toi_long": combo_toi(2, 1, min_seconds=10),
    "combo_on_ice_stats": combo_stats(2, 0, 15, both=False),
    "combo_on_ice_stats_both": combo_stats(2, 1, 15, both=True),
    "combo_shot_metrics": combo_shots(),
    "on_ice_stats_by_player_strength": f"""with {ice()}, {ROSTER}, {NAMED_LAST}, {CREDIT},
 t as (select ice.gameId, player1Id, l12 as strength, count(*) as seconds from ice
   join lab on lab.gameId=ice.gameId and lab.s=ice.s where isGoalie=0 group by 1,2,3),
 k as (select ice.gameId, player1Id, l12 as strength, {_stat_sums([*COUNTS, *XG, *PEN, *PUCK])} from ice
   join lab on lab.gameId=ice.gameId and lab.s=ice.s
   join credit q on q.gameId=ice.gameId and q.team=ice.eventTeam and q.t=ice.s+1 where isGoalie=0 group by 1,2,3)
 select t.gameId, t.player1Id, name as player1Name, team as eventTeam, t.strength, t.seconds,
  round(t.seconds/60.0,6) as minutes, {_stat_out([*COUNTS, *XG, *PEN, *PUCK])}, {_per60([*COUNTS, *XG, *PEN])}
 from t left join k on k.gameId=t.gameId and k.player1Id=t.player1Id and k.strength=t.strength
 left join names on names.gameId=t.gameId and names.player1Id=t.player1Id""",
    "team_strength_aggregates": f"""with {ice()}, {CREDIT},
 t as (select gameId, l12 as strength, count(*) as seconds from lab group by 1,2),
 k as (select q.gameId, q.team, coalesce(l12,'0*v0*') as strength, {_stat_sums([*COUNTS, *XG, *PEN])}
   from credit q left join lab on lab.gameId=q.gameId and lab.s=q.t-1 group by 1,2,3)
 select t.gameId, v.team, case when v.team='AAA' then 'BBB' else 'AAA' end as opp, t.strength,
  cast(t.seconds as double) as seconds, round(t.seconds/60.0,6) as minutes,
  {_stat_out([*COUNTS, *XG, *PEN])}, {_per60([*COUNTS, *XG, *PEN])}
 from t, (values ('AAA'),('BBB')) v(team)
 left join k on k.gameId=t.gameId and k.team=v.team and k.strength=t.strength""",
}
