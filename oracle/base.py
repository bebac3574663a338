"""Shared CTEs: the fixture views and the per-second ice."""

PBP = """
pbp as (
 select event_id, event_id as seq, user_id, k, cast(gameId as int) as gameId, elapsedTime,
  cast(floor(elapsedTime/1200.0) as int)+1 as period, Event, eventTeam,
  'AAA' as homeTeam, 'BBB' as awayTeam, case when eventTeam='AAA' then 1 else 0 end as isHome,
  case when Event in ('ON','OFF') then pid end as player1Id,
  case when Event in ('ON','OFF') then case when pid<2 then 1 else 0 end end as isGoalie,
  case when Event in ('SHOT','GOAL','MISS') then cast(k as double)/250 end as xG,
  case when Event not in ('ON','OFF') and event_id%17<>0 then cast(k*2-99 as double) end as xCoord,
  case when Event not in ('ON','OFF') and event_id%17<>0 then cast((user_id*7+k)%85-42 as double) end as yCoord,
  case when Event='GOAL' then cast(k%7 as int) end as homeScore,
  case when Event='GOAL' then cast(k%5 as int) end as awayScore,
  cast(3+event_id%4 as int) as home_on_count, cast(3+event_id%5 as int) as away_on_count,
  case when k%20=0 then 1 else 0 end as pulled_home, case when k%20=1 then 1 else 0 end as pulled_away
 from (select event_id, user_id, k, dayofyear(ts) as gameId,
   cast(floor((hour(ts)*3600+minute(ts)*60+second(ts))/24.0) as int) as elapsedTime,
   user_id%12 as pid, case when user_id%2=0 then 'AAA' else 'BBB' end as eventTeam,
   case event_type when 'view' then 'ON' when 'signup' then 'OFF' when 'click' then 'SHOT'
    when 'error' then case when k<50 then 'MISS' else 'BLOCK' end
    else case when k<15 then 'GOAL' when k<35 then 'PENL' when k<50 then 'GIVE' when k<65 then 'TAKE'
              when k<80 then 'FAC' when k<90 then 'HIT' else 'STOP' end end as Event
  from (select event_id, ts, user_id, event_type, cast(json_extract_string(props,'$.k') as int) as k
        from events) e) x
)"""

ROSTER = """
roster as (
 select c_custkey//24 as gameId, c_custkey%24 as playerId, c_name as fullName, case when c_custkey%24<12 then 1 else 0 end as isHome,
  case when c_custkey%12=0 then 'G' when c_custkey%12<5 then 'D' when c_custkey%3=0 then 'L' else 'C' end as positionCode,
  cast(c_custkey%24+10 as int) as sweaterNumber
 from customer
)"""

SHIFTS = """
shifts as (
 select l_orderkey*10+l_linenumber as shift_id, l_suppkey as gameId, l_partkey%24 as playerId,
  case when l_partkey%24<12 then 1 else 0 end as isHome,
  case when l_partkey%12=0 then 'G' when l_partkey%12<5 then 'D' else 'C' end as positionCode,
  cast((l_orderkey*37+l_linenumber*11)%3600 as int) as elapsed_time_start,
  cast((l_orderkey*37+l_linenumber*11)%3600 as int)+cast(floor(l_quantity) as int) as elapsed_time_end
 from lineitem
)"""


def ice(changes_only: bool = False) -> str:
    """CTEs ``ice`` (who is on during second s) and ``lab`` (counts and labels of second s)."""
    scope = "where Event in ('ON','OFF')" if changes_only else ""
    return f"""{PBP},
gend as (select gameId, max(elapsedTime) as e from pbp {scope} group by 1),
sec as (select gameId, cast(unnest(range(0, e)) as int) as s from gend),
st as (select gameId, eventTeam, isGoalie, player1Id, elapsedTime as t,
        max(case when Event='ON' then 1 else 0 end) as on_
       from pbp where Event in ('ON','OFF') group by all),
who as (select distinct gameId, eventTeam, isGoalie, player1Id from st),
grid as (select w.*, s from who w join sec using (gameId)),
ice as (select g.gameId, g.s, g.eventTeam, g.isGoalie, g.player1Id
        from grid g asof join st on g.gameId=st.gameId and g.eventTeam=st.eventTeam
         and g.isGoalie=st.isGoalie and g.player1Id=st.player1Id and g.s >= st.t
        where st.on_=1),
lab as (select gameId, s, s1, s2, g1, g2,
         s1 || case when g1>0 then '' else '*' end as left_, s2 || case when g2>0 then '' else '*' end as right_,
         (s1 || case when g1>0 then '' else '*' end) || 'v' || (s2 || case when g2>0 then '' else '*' end) as l12,
         (s2 || case when g2>0 then '' else '*' end) || 'v' || (s1 || case when g1>0 then '' else '*' end) as l21
        from (select sec.gameId, sec.s,
               cast(count(*) filter (eventTeam='AAA' and isGoalie=0) as int) as s1,
               cast(count(*) filter (eventTeam='BBB' and isGoalie=0) as int) as s2,
               cast(count(*) filter (eventTeam='AAA' and isGoalie=1) as int) as g1,
               cast(count(*) filter (eventTeam='BBB' and isGoalie=1) as int) as g2
              from sec left join ice on sec.gameId=ice.gameId and sec.s=ice.s
              group by 1,2))"""
