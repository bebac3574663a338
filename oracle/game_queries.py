"""Answers for whole games, straight from the rows the documents were rendered from."""

from oracle.base import PBP
from oracle.row_queries import _GEO, RANK, shot_score

GAMES = f"""{PBP},
 e as (select *, event_id//100 as g, elapsedTime%1200 as clock, user_id%12 as pid, {RANK} as rank from pbp),
 known as (select distinct g from e where Event not in ('ON','OFF')),
 sh as (select g, event_id, pid, pid%2=0 as home, pid<2 as goalie, elapsedTime as a, elapsedTime+30 as b, period from e where Event='ON'),
 marks as (select g, a as t from sh union select g, b from sh),
 lab as (select marks.g, marks.t,
   count(*) filter (home and not goalie) as h, count(*) filter (not home and not goalie) as w,
   count(*) filter (home and goalie) as hg, count(*) filter (not home and goalie) as wg
  from marks left join sh on sh.g=marks.g and sh.a<=marks.t and sh.b>marks.t group by 1,2),
 tail as (select g, max(t) as m from marks group by 1),
 plays as (select *, case when pulled_home=0 then 2 else 3 end as hn, case when pulled_home=0 then '' else '*' end as star,
   1000+2+event_id%5*2 as h1, 1000+2+(event_id+2)%5*2 as h2, 1000+3+event_id%5*2 as a1, 1000+3+(event_id+1)%5*2 as a2,
   coalesce((select arg_max(b.homeScore, b.event_id) from e b where b.g=e.g and b.event_id<=e.event_id and b.homeScore is not null and b.Event not in ('ON','OFF')),0) as hs
  from e where Event not in ('ON','OFF')),
 ch as (select g, event_id, 'ON' as Event, a as t, pid, home, period from sh union all select g, event_id, 'OFF', b, pid, home, period from sh)"""

def _pipeline() -> str:
    """Plays with the play before them, its geometry and the stored model's score; changes without any of it."""
    def slots(ids: dict[str, str], names: dict[str, str], goalies: dict[str, tuple[str, str]]) -> str:
        out = []
        for side in ("home", "away"):
            for i in range(1, 7):
                out += [f"{ids.get(f'{side}{i}', 'null')}::bigint as {side}_skater_id_{i}",
                        f"{names.get(f'{side}{i}', 'null')}::varchar as {side}_skater_name_{i}"]
            gid, name = goalies.get(side, ("null", "null"))
            out += [f"{gid}::bigint as {side}_goalie_id", f"{name}::varchar as {side}_goalie_name"]
        return ", ".join(out)

    def name(c: str) -> str:
        return f"('F'||({c}-1000)||' L'||({c}-1000))"

    ids = {"home1": "h1", "home2": "h2", "away1": "a1", "away2": "a2"}
    names = {k: name(v) for k, v in ids.items()}
    goalies = {"home": ("case when hn=2 then 1000 end", "case when hn=2 then 'F0 L0' end"), "away": ("1001", "'F1 L1'")}
    return f"""with {GAMES},
 w as (select *, {_GEO}, eventTeam='AAA' as isH from plays),
 x as (select *, sqrt((89-xn)*(89-xn)+yn*yn) as distanceFromGoal, degrees(atan2(yn, 89-xn)) as angle_signed,
   (select count(*) from plays b where b.g=w.g and (b.elapsedTime, b.rank, b.event_id) <= (w.elapsedTime, w.rank, w.event_id))
    + (select count(*) from ch where ch.g=w.g and (ch.t, 8) < (w.elapsedTime, w.rank)) as position from w),
 o as (select *, lag(Event) over p as pe, lag(elapsedTime) over p as pt, lag(eventTeam) over p as pteam, lag(xn) over p as px
  from x window p as (partition by g order by elapsedTime, rank, event_id)),
 f as (select *, pe as previousEvent, elapsedTime-pt as timeDiff, px as previousEventXNorm,
   cast(case when isH then hn-2 else 2-hn end as double) as strengthDiff,
   cast(case when isH then hs - (case when Event='GOAL' then 1 else 0 end) else -(case when Event='GOAL' then 1 else 0 end) - hs end as double)+0.0 as scoreDiff,
   not isH and hn=3 as shootEmptyNet,
   coalesce(pe='SHOT' and Event='SHOT' and pteam=eventTeam and elapsedTime-pt between 0 and 3, false) as isRebound from o)
 select g as gameId, event_id as eventId, Event, position, elapsedTime, xn as x_norm, previousEvent, timeDiff, strengthDiff, scoreDiff,
  shootEmptyNet, isRebound, Event='GOAL' as isGoal,
  case when Event in ('GOAL','SHOT','MISS') then round({shot_score("'<NA>'")},6) end as xG, {slots(ids, names, goalies)} from f
 union all
 select ch.g, null, ch.Event,
  (select count(*) from plays b where b.g=ch.g and (b.elapsedTime, b.rank) <= (ch.t, 8))
   + (select count(*) from ch c where c.g=ch.g and (c.t, c.Event='OFF', not c.home, c.pid, c.event_id) <= (ch.t, ch.Event='OFF', not ch.home, ch.pid, ch.event_id)),
  ch.t, null, null, null, null,
  (case when home then 1 else -1 end) * coalesce((select arg_max(hs, (b.elapsedTime, b.rank, b.event_id)) from plays b
    where b.g=ch.g and (b.elapsedTime, b.rank) < (ch.t, 8)),0)::double + 0.0,
  false, null, false, null, {slots({}, {}, {})} from ch"""


SQL = {
    "game_shifts": f"""with {GAMES}
 select sh.g as gameId, case when known.g is not null then 1000+pid end as playerId, case when known.g is not null then 'F'||pid||' L'||pid end as fullName,
  case when known.g is not null then cast(1+pid%2 as bigint) end as teamId, case when home then 1 else 0 end as isHome,
  case when known.g is not null then case when pid<2 then 'G' when pid%3<>0 then 'D' else 'C' end end as positionCode,
  cast(10+pid as int) as jersey_number, case when home then 'Home' else 'Away' end as team_name, period as period_number, a as elapsed_time_start,
  b as elapsed_time_end, 30 as duration_seconds, case when known.g is not null then 'AAA' end as homeTeam, case when known.g is not null then 'BBB' end as awayTeam
 from sh left join known using (g)""",
    "game_players": f"""with {GAMES}
 select distinct sh.g as gameId, 1000+pid as playerId, 'F'||pid||' L'||pid as fullName, 'F'||pid as firstName, 'L'||pid as lastName, case when home then 'AAA' else 'BBB' end as team,
  case when pid<2 then 'G' when pid%3<>0 then 'D' else 'F' end as position, cast(10+pid as int) as sweaterNumber
 from sh join known using (g)""",
    "game_pbp": f"""with {GAMES}
 select g as gameId, event_id as eventId, Event, period as Per, elapsedTime,
  (select count(*) from plays b where b.g=p.g and (b.elapsedTime, b.rank, b.event_id) <= (p.elapsedTime, p.rank, p.event_id))
   + (select count(*) from ch where ch.g=p.g and (ch.t, 8) < (p.elapsedTime, p.rank)) as position,
  eventTeam, case when Event in ('SHOT','MISS','GOAL') then 1000+pid end as player1Id,
  case when Event in ('SHOT','MISS','GOAL') then 'F'||pid||' L'||pid end as player1Name, hs as homeScore, 'EV' as strength,
  case when isHome=1 then hn||'v2' else '2v'||hn end as gameStrength,
  case when isHome=1 then hn||star||'v2' else '2v'||hn||star end as detailedGameStrength,
  h1||','||h2||case when hn=3 then ',-1' else '' end as home_on_id, a1||','||a2 as away_on_id,
  case when hn=2 then '1000' else '' end as homeGoalie_on_id,
  'F'||(h1-1000)||' L'||(h1-1000)||',F'||(h2-1000)||' L'||(h2-1000)||case when hn=3 then ',99' else '' end as home_on_full_name,
  cast(hn-2 as int) as unmapped_count
 from plays p
 union all
 select ch.g, null, ch.Event, ch.period, ch.t,
  (select count(*) from plays b where b.g=ch.g and (b.elapsedTime, b.rank) <= (ch.t, 8))
   + (select count(*) from ch c where c.g=ch.g and (c.t, c.Event='OFF', not c.home, c.pid, c.event_id) <= (ch.t, ch.Event='OFF', not ch.home, ch.pid, ch.event_id)),
  case when home then 'AAA' else 'BBB' end, 1000+pid, 'F'||pid||' L'||pid,
  coalesce((select arg_max(hs, (b.elapsedTime, b.rank, b.event_id)) from plays b where b.g=ch.g and (b.elapsedTime, b.rank) < (ch.t, 8)),0),
  null, case when ch.t<m then h||'v'||w end,
  case when ch.t<m then h||case when hg=0 then '*' else '' end||'v'||w||case when wg=0 then '*' else '' end end, null, null, null, null, null
 from ch join lab on lab.g=ch.g and lab.t=ch.t join tail on tail.g=ch.g""",
    "game_pipeline": _pipeline(),
}
