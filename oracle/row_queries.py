"""Answers for shifts, row order, on-ice lists, scalar functions and shot features."""

from oracle.base import PBP, ROSTER, SHIFTS

RANK = """case Event when 'PGSTR' then 1 when 'PGEND' then 2 when 'GOAL' then 5 when 'STOP' then 6 when 'PENL' then 7
 when 'ON' then 8 when 'OFF' then 8 when 'FAC' then 12 when 'BLOCK' then 3 when 'GIVE' then 3 when 'HIT' then 3
 when 'MISS' then 3 when 'SHOT' then 3 when 'TAKE' then 3 else 99 end"""

SEGMENTS = f"""{SHIFTS},
 times as (select distinct gameId, t from (select gameId, elapsed_time_start as t from shifts where elapsed_time_end>elapsed_time_start
   union all select gameId, elapsed_time_end from shifts where elapsed_time_end>elapsed_time_start)),
 seg as (select gameId, t as t_start, (select min(u.t) from times u where u.gameId=times.gameId and u.t>times.t) as t_end from times),
 cnt as (select g.gameId, g.t_start, g.t_end,
   cast(count(*) filter (s.isHome=1 and s.positionCode<>'G') as int) as home_skaters,
   cast(count(*) filter (s.isHome=0 and s.positionCode<>'G') as int) as away_skaters,
   cast(count(*) filter (s.isHome=1 and s.positionCode='G') as int) as home_goalie,
   cast(count(*) filter (s.isHome=0 and s.positionCode='G') as int) as away_goalie
  from seg g left join shifts s on s.gameId=g.gameId and s.elapsed_time_start<=g.t_start and s.elapsed_time_end>g.t_start
  where g.t_end is not null group by 1,2,3),
 lab as (select *, home_skaters || 'v' || away_skaters as team_str_home,
   home_skaters || case when home_goalie=0 then '*' else '' end as home_strength,
   away_skaters || case when away_goalie=0 then '*' else '' end as away_strength from cnt)"""

EVENTS = """ev as (select shift_id, gameId, playerId as player1Id, isHome, case when positionCode='G' then 1 else 0 end as isGoalie,
   'ON' as Event, elapsed_time_start as elapsedTime from shifts
  union all select shift_id, gameId, playerId, isHome, case when positionCode='G' then 1 else 0 end, 'OFF', elapsed_time_end from shifts)"""

LISTS = f"""{PBP},
 r as (select event_id, gameId, elapsedTime, period as Per, Event, isHome,
  [event_id%12, (event_id+5)%12, (event_id+7)%12, event_id%5+20, 31] as hi,
  case when event_id%11<>0 then [(event_id+1)%12+40, (event_id+3)%12+40, 61] else [] end as ai,
  event_id%3=0 as hg, event_id%4=0 as ag
 from pbp where Event not in ('ON','OFF'))"""

_GEO = """case when xCoord<0 then -xCoord else xCoord end as xn, case when xCoord<0 then -yCoord else yCoord end as yn"""

FEATURES = f"""{PBP},
 g as (select *, {_GEO} from pbp),
 h as (select *, sqrt((89-xn)*(89-xn)+yn*yn) as dist, degrees(atan2(yn, 89-xn))+0.0 as ang, Event not in ('ON','OFF') as play,
   case when eventTeam='AAA' then home_on_count-away_on_count else away_on_count-home_on_count end as sd,
   homeScore - case when Event='GOAL' and eventTeam='AAA' then 1 else 0 end as hs,
   awayScore - case when Event='GOAL' and eventTeam='BBB' then 1 else 0 end as aws from g),
 pl as (select event_id, row_number() over (partition by gameId order by elapsedTime, seq) as rn from h where play),
 hp as (select h.*, pl.rn from h left join pl using (event_id)),
 prev as (select a.*, b.Event as pe, b.eventTeam as pt, b.elapsedTime as pel, b.dist as pd, b.ang as pa, b.xn as px, b.yn+0.0 as py
  from hp a left join hp b on b.gameId=a.gameId and b.rn=a.rn-1),
 f as (select event_id, gameId, Event, xn as x_norm, yn+0.0 as y_norm, dist as distanceFromGoal, ang as angle_signed,
  eventTeam='AAA' as isHome, cast(sd as double) as strengthDiff,
  cast(case when eventTeam='AAA' then hs-aws else aws-hs end as double) as scoreDiff,
  cast(case when eventTeam='AAA' then home_on_count else away_on_count end as double) as shooterSkaters,
  cast(case when eventTeam='AAA' then away_on_count else home_on_count end as double) as defendingSkaters,
  case when eventTeam='AAA' then pulled_away=1 else pulled_home=1 end as shootEmptyNet,
  pe as previousEvent, pt as previousTeam,
  case when play then coalesce(pt=eventTeam,false) end as previousEventSameTeam, pel as previousElapsedTime,
  pd as previousEventDistanceFromGoal, pa as previousEventAngleSigned, px as previousEventXNorm, py as previousEventYNorm,
  elapsedTime-pel as timeDiff,
  case when play then coalesce(pe='SHOT' and Event='SHOT' and pt=eventTeam and elapsedTime-pel between 0 and 3, false) end as isRebound,
  Event='GOAL' as isGoal, k, elapsedTime, period from prev)"""


def _wide() -> str:
    out = ["event_id", "gameId", "elapsedTime", "Per", "Event", "isHome"]
    for side, ids, goalie, names in (("home", "hi", "hg", 4), ("away", "ai", "ag", 99)):
        gid = 31 if side == "home" else 61
        line = f"case when {goalie} then list_filter({ids}, lambda x: x<>{gid}) else {ids} end"
        for i in range(1, 5):
            pid = f"({line})[{i}]"
            out.append(f"{pid} as {side}_skater_id_{i}")
            # names exist for the first four home ids and for all away ids
            known = f"list_contains({ids}[1:{names}], {pid})"
            out.append(f"case when {known} then 'P' || {pid} end as {side}_skater_name_{i}")
        shown = f"({line})[1:4]"
        left = f"list_filter({ids}, lambda y: not list_contains({shown}, y))"
        out.append(f"case when {goalie} then {gid} when len({left})=1 then ({left})[1] end as {side}_goalie_id")
        lone = f"case when len({left})=1 and list_contains({ids}[1:{names}], ({left})[1]) then 'P' || ({left})[1] end"
        out.append(f"case when {goalie} then 'P{gid}' else {lone} end as {side}_goalie_name")
    return f"with {LISTS} select {', '.join(out)} from r"


def _ffill(c: str, kind: str = "int") -> str:
    if c.endswith("SOG"):
        return f"0 as {c}"
    return (f"coalesce((select arg_max(b.{c}, b.o) from o b where b.gameId=a.gameId and b.o<=a.o and b.{c} is not null),0) as {c}")


_LEVELS = {"shotType": ["wrist", "slap", "<NA>"], "strength": ["EV", "PP"], "previousEvent": ["SHOT", "FAC", "STOP"]}


def _design() -> str:
    num = ["distanceFromGoal", "angle_signed", "x_norm", "y_norm"]
    num2 = ["strengthDiff", "scoreDiff", "shooterSkaters", "defendingSkaters", "previousEventDistanceFromGoal",
            "previousEventAngleSigned", "previousEventXNorm", "previousEventYNorm"]
    cols = ["event_id"] + [f"round({c},6) as {c}" for c in num + num2]
    cols += ["cast(period as double) as Per", "cast(elapsedTime%1200 as double) as timeInPeriodSec",
             "cast(1200-elapsedTime%1200 as double) as timeRemainingSec", "cast(timeDiff as double) as timeDiff"]
    cols += [f"cast(coalesce({c},false) as int) as {c}" for c in ("isRebound", "isHome", "shootEmptyNet", "previousEventSameTeam")]
    cat = {
        "shotType": "case when k%3=0 then 'wrist' when k%3=1 then 'slap' else '<NA>' end",
        "strength": "case when event_id%2=0 then 'EV' else 'PP' end",
        "previousEvent": "coalesce(previousEvent,'<NA>')",
    }
    cols += [f"cast({cat[c]}='{v}' as int) as \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs]
    cols.append("cast(0 as double) as \"previousEvent_ANTHEM\"")
    return f"with {FEATURES} select {', '.join(cols)} from f where Event in ('GOAL','SHOT','MISS')"


def shot_score(shot_type: str) -> str:
    """The three trees of the stored shot model, written out."""
    first = f"""case when coalesce(distanceFromGoal,60) <= 30.5
      then case when angle_signed <= -10 then 0.4 when isRebound then 0.9 else 0.2 end
      when {shot_type} in ('wrist','<NA>') then -0.6 else -0.9 end"""
    second = """case when coalesce(previousEvent,'<NA>') in ('FAC','STOP') then case when coalesce(timeDiff,9) <= 4 then 0.3 else -0.1 end
      when strengthDiff <= 0 then -0.2 when shootEmptyNet then 0.7 else 0.1 end"""
    third = "case when scoreDiff <= -1 then 0.15 when previousEventXNorm <= 25 then -0.35 else 0.05 end"
    return f"1/(1+exp(-2*(-0.25 + ({first})::double + 0.5*({second})::double + 0.25*({third})::double)))"


SQL = {
    "shift_events": f"with {SHIFTS}, {EVENTS} select * from ev",
    "strength_segments_multiset": f"""with {SEGMENTS}
 select gameId, t_start, t_end, home_skaters, away_skaters, home_goalie, away_goalie,
  case when home_goalie=0 then 1 else 0 end as pulled_home, case when away_goalie=0 then 1 else 0 end as pulled_away from cnt""",
    "strength_by_second": f"""with {SEGMENTS}
 select gameId, cast(unnest(range(t_start, t_end)) as int) as elapsedTime, team_str_home, home_strength, away_strength from lab""",
    "shift_event_strength": f"""with {SEGMENTS}, {EVENTS}
 select ev.*, team_str_home as gameStrength, home_strength || 'v' || away_strength as detailedGameStrength
 from ev left join lab on lab.gameId=ev.gameId and lab.t_start<=ev.elapsedTime and ev.elapsedTime<lab.t_end""",
    "attach_roster": f"""with {SHIFTS}, {ROSTER},
 spots as (select distinct s.gameId, r.playerId, r.fullName, r.isHome, r.sweaterNumber from shifts s join roster r on r.playerId=s.playerId and r.gameId=s.gameId)
 select s.shift_id, s.gameId, s.isHome, cast(s.playerId+9 as int) as jersey_number, s.elapsed_time_start, p.playerId, p.fullName
 from shifts s left join spots p on p.gameId=s.gameId and p.isHome=s.isHome and p.sweaterNumber=s.playerId+9""",
    "attach_position": f"""with {SHIFTS}, {EVENTS}
 select ev.shift_id, ev.gameId, ev.player1Id, ev.Event, ev.elapsedTime,
  case when ev.player1Id%12=0 then 'G' when ev.player1Id%12<5 then 'D' else 'C' end as positionCode from ev""",
    "occurrence_join": f"""with {PBP},
 p as (select gameId, Event, period as Per, elapsedTime as Time, seq from pbp where Event not in ('ON','OFF')),
 n as (select a.*, (select count(*) from p b where b.gameId=a.gameId and b.Event=a.Event and b.Time=a.Time and b.seq<a.seq) as lo,
   (select count(*) from p b where b.gameId=a.gameId and b.Event=a.Event and b.Time=a.Time and b.seq>a.seq) as hi from p a)
 select a.gameId, a.Event, a.Per, a.Time, cast(a.lo as int) as merge_idx, a.seq, b.seq as seq_api
 from n a left join n b on b.gameId=a.gameId and b.Event=a.Event and b.Time=a.Time and b.hi=a.lo""",
    "scoreboard_ffill": f"""with {PBP},
 o as (select *, row_number() over (partition by gameId order by elapsedTime, {RANK}, seq) as o from pbp)
 select event_id, gameId, Event, elapsedTime, {_ffill('awaySOG')}, {_ffill('homeSOG')}, {_ffill('homeScore')}, {_ffill('awayScore')}
 from o a""",
    "canonical_order": f"""with {PBP},
 p as (select event_id, seq, gameId, Event, case when event_id%19<>0 then elapsedTime end as elapsedTime,
   case when event_id%3<>0 then 'S' || (k%4) end as Str from pbp)
 select event_id, gameId, Event, elapsedTime, Str,
  row_number() over (partition by gameId order by elapsedTime nulls last, {RANK}, Str nulls last, seq) as "#" from p""",
    "on_ice_long": f"""with {LISTS}
 select event_id as seq, gameId, elapsedTime, Per, Event, 'home' as team_side, cast(i as int) as slot_index, hi[i] as player_id,
  case when i<=4 then 'P' || hi[i] end as player_name from r, (select unnest(range(1,6)) as i) x
 union all select event_id, gameId, elapsedTime, Per, Event, 'away', cast(i as int), ai[i], 'P' || ai[i]
  from r, (select unnest(range(1,4)) as i) x where len(ai)>=i""",
    "on_ice_wide": _wide(),
    "on_ice_strengths": f"""with {LISTS},
 c as (select event_id, isHome, 5 as h, len(ai) as a, case when hg then 1 else 0 end as hgc, case when ag then 1 else 0 end as agc from r),
 d as (select *, h || case when hgc=0 then '*' else '' end as hs, a || case when agc=0 then '*' else '' end as as_ from c)
 select event_id, h as home_on_count, cast(a as int) as away_on_count, hgc as homeGoalie_on_count, agc as awayGoalie_on_count,
  h-hgc as n_home_skaters, cast(a-agc as int) as n_away_skaters, 1-hgc as pulled_home, 1-agc as pulled_away,
  case when a>0 then case when isHome=1 then hs else as_ end end as home_strength,
  case when a>0 then case when isHome=1 then as_ else hs end end as away_strength,
  case when a>0 then case when isHome=1 then h || 'v' || a else a || 'v' || h end end as gameStrength,
  case when a>0 then case when isHome=1 then hs || 'v' || as_ else as_ || 'v' || hs end end as detailedGameStrength from d""",
    "on_ice_mapping": f"""with {PBP}, {SHIFTS}, {ROSTER},
 spots as (select distinct s.gameId, r.playerId, r.fullName, r.sweaterNumber, r.isHome from shifts s
   join roster r on r.playerId=s.playerId and r.gameId=s.gameId),
 e as (select event_id, event_id%97 as gameId, i, home, event_id*i%14+case when home=1 then 8 else 20 end as j
  from pbp, (select unnest([1,2,3]) as i) x, (select unnest([0,1]) as home) y where Event not in ('ON','OFF'))
 select e.event_id, e.gameId, string_agg(cast(coalesce(playerId,-1) as varchar), ',' order by i) filter (home=1) as home_on_id,
  string_agg(coalesce(fullName, cast(j as varchar)), ',' order by i) filter (home=1) as home_on_full_name,
  string_agg(cast(coalesce(playerId,-1) as varchar), ',' order by i) filter (home=0) as away_on_id,
  string_agg(coalesce(fullName, cast(j as varchar)), ',' order by i) filter (home=0) as away_on_full_name,
  cast(count(*) filter (playerId is null) as int) as unmapped_count
 from e left join spots s on s.gameId=e.gameId and s.isHome=e.home and s.sweaterNumber=e.j group by 1,2""",
    "event_players": f"""with {PBP}
 select event_id, event_api, Event, cast({RANK} as int) as rank,
  user_id*100 + case Event when 'FAC' then 0 when 'HIT' then 2 when 'BLOCK' then 4 when 'SHOT' then 4 when 'MISS' then 4
    when 'GOAL' then 6 when 'GIVE' then 8 when 'TAKE' then 8 when 'PENL' then 9 end as player1Id,
  user_id*100 + case Event when 'FAC' then 1 when 'HIT' then 3 when 'BLOCK' then 5 when 'GOAL' then 7 when 'PENL' then 10 end as player2Id,
  user_id*100 + case Event when 'PENL' then 11 end as player3Id
 from (select *, case Event when 'SHOT' then 'shot-on-goal' when 'GOAL' then 'goal' when 'MISS' then 'missed-shot'
   when 'BLOCK' then 'blocked-shot' when 'PENL' then 'penalty' when 'GIVE' then 'giveaway' when 'TAKE' then 'takeaway'
   when 'FAC' then 'faceoff' when 'HIT' then 'hit' when 'STOP' then 'stoppage' end as event_api from pbp) p where Event not in ('ON','OFF')""",
    "rejected_games": f"""with {PBP}
 select cast(event_id%997 as int) as gameId,
  count(distinct case when k%25=0 then 'CCC' when k%2=0 then eventTeam end) as n_teams from pbp
 group by 1 having count(distinct case when k%25=0 then 'CCC' when k%2=0 then eventTeam end)<>2""",
    "clock_functions": """with n as (select *, l_orderkey*7+l_linenumber as n from lineitem),
 m as (select *, cast(n%1300 as int) as s, cast(n%6+1 as int) as p, cast(l_suppkey%4 as int) as gt from n),
 q as (select *, case when n%13<>0 and n%17<>0 then s end as sec, case when p<6 then p end as per from m)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, sec as seconds,
  lpad(cast(s//60 as varchar),2,'0') || ':' || lpad(cast(s%60 as varchar),2,'0') as elapsed, '20:00' as remaining, per as period,
  case when per<>5 then sec+(per-1)*1200 end as elapsed_any,
  case when per<>5 or gt=3 then sec+(per-1)*1200 end as elapsed_typed from q""",
    "name_functions": """with c as (select *, case c_custkey%7 when 0 then 'G' when 1 then 'D' when 2 then 'l' when 3 then 'forward'
   when 6 then null else 'C' end as code from customer)
 select c_custkey, '20242025/PL' || lpad(cast(20000+c_custkey as varchar),6,'0') as report_key, cast(c_custkey%99 as int) as jersey,
  cast(null as int) as no_jersey, c_name || ' ' || code as full_name,
  case when code in ('G','D') then code else 'F' end as position_group,
  case code when 'G' then 'G' when 'D' then 'D' when 'forward' then 'F' end as position_letter,
  case when c_custkey%2=1 then 'AAA' else 'BBB' end as team from c""",
    "as_array_text": "select event_id, case when event_id%5<3 then event_id || ',' || user_id else '' end as items from events",
    "geometry": f"""with {PBP}, g as (select *, {_GEO} from pbp where Event not in ('ON','OFF'))
 select event_id, coalesce(xCoord,0) as x_normalized, coalesce(yCoord,0) as y_normalized,
  round(sqrt(coalesce(xCoord,0)*coalesce(xCoord,0)+coalesce(yCoord,0)*coalesce(yCoord,0)),6) as distance_from_goal, xn as x_norm,
  yn+0.0 as y_norm, round(sqrt((89-xn)*(89-xn)+yn*yn),6) as distanceFromGoal, round(degrees(atan2(yn,89-xn)),6)+0.0 as angle_signed from g""",
    "xg_features": f"""with {FEATURES}
 select event_id, gameId, Event, x_norm, y_norm, round(distanceFromGoal,6) as distanceFromGoal, round(angle_signed,6) as angle_signed,
  isHome, strengthDiff, scoreDiff, shooterSkaters, defendingSkaters, shootEmptyNet, previousEvent, previousTeam, previousEventSameTeam,
  previousElapsedTime, round(previousEventDistanceFromGoal,6) as previousEventDistanceFromGoal,
  round(previousEventAngleSigned,6) as previousEventAngleSigned, previousEventXNorm, previousEventYNorm, timeDiff, isRebound, isGoal from f""",
    "shots_design_matrix": _design(),
    "xg_scores": f"""with {FEATURES}
 select event_id, gameId, Event, case when Event in ('GOAL','SHOT','MISS') then round({shot_score("(case k%3 when 0 then 'wrist' when 1 then 'slap' else '<NA>' end)")},6) end as xG from f""",
    "xg_frame": f"""with {PBP}
 select Event, count(*) as n, count(*) filter (Event in ('GOAL','SHOT','MISS')) as scored, 0::bigint as outside,
  count(distinct event_id) as events from pbp group by 1""",
}

SQL["shift_events_with_strength"] = SQL["shift_event_strength"]
