"""Answers for reports and feeds: the rows the documents were rendered from."""

from oracle.base import PBP, SHIFTS


def mm(s: str) -> str:
    return f"(cast(({s})//60 as varchar) || ':' || lpad(cast(({s})%60 as varchar),2,'0'))"


def mm2(s: str) -> str:
    return f"(lpad(cast(({s})//60 as varchar),2,'0') || ':' || lpad(cast(({s})%60 as varchar),2,'0'))"


SHIFT_ROWS = f"""{SHIFTS},
 q as (select gameId, case when isHome=1 then 'Home' else 'Away' end as team_type, shift_id//50000 as part, playerId, shift_id,
   elapsed_time_start%1200 as tip, elapsed_time_start//1200+1 as per, elapsed_time_end-elapsed_time_start as len from shifts)"""

#: A player's rows stand in the order of their text, then a row of sums and one that ends the player.
SHIFT_PLACES = f"""{SHIFT_ROWS},
 per_player as (select gameId, team_type, part, playerId, count(*) as n from q group by all),
 before as (select gameId, team_type, part, playerId, n, cast(coalesce(sum(n+2) over (partition by gameId, team_type, part order by playerId
   rows between unbounded preceding and 1 preceding),0) as bigint) as ahead from per_player),
 place as (select *, (case when team_type='Home' then 0 else 1152921504606846976 end) + cast(part as bigint)*1099511627776 + ahead as start from before)"""

CUSTOMERS = """c as (select *, c_custkey//40 as report, c_custkey%40 as spot, ['C','L','R','D','G'][c_custkey%5+1] as letter from customer),
 docs as (select report, count(*) filter (spot<16) as na, count(*) filter (spot between 16 and 31) as nh from c group by 1)"""


def nulls(names: dict[str, str]) -> str:
    return ", ".join(f"cast(null as {t}) as {n}" for n, t in names.items())


SQL = {
    "report_events": f"""with {PBP},
 q as (select *, elapsedTime%1200 as c, event_id%23<>0 as iced, pulled_home=0 as hg from pbp where Event not in ('ON','OFF'))
 select gameId, row_number() over (partition by gameId, event_id//100 order by event_id)-1 as seq, cast(event_id as varchar) as "#", cast(period as varchar) as Per, 'EV' as Str,
  {mm('c')} || {mm('1200-c')} as "Time:Elapsed Game", Event, 'AAA #' || k || ' A&B' as Description,
  case when iced then (10+event_id%12) || ',' || (30+event_id%7) || case when hg then '' else ',99' end else '' end as home_on_ice,
  case when iced then (50+k%5) || ',' || (70+k%3) else '' end as away_on_ice,
  case when iced and hg then '91' else '' end as home_goalie, case when iced then '90' else '' end as away_goalie,
  {mm2('c')} as timeInPeriod, {mm2('1200-c')} as timeRemaining, c as timeInPeriodSec, 1200-c as timeRemainingSec from q""",
    "report_shifts": f"""with {SHIFT_PLACES}
 select gameId, team_type, start + row_number() over (partition by gameId, team_type, part, playerId
   order by shift_id, {mm('tip+len')}) - 1 as seq, (playerId+10) || ' PLAYER, NR' || playerId as player_name, cast(playerId+10 as int) as jersey_number,
  'TEAM ' || team_type as team_name, cast(shift_id%10 as int) as shift_number,
  case when shift_id%50=0 then 'OT' else cast(per as varchar) end as period,
  {mm('tip')} || ' / ' || {mm('1200-tip')} as start_time_elapsed_game, {mm('tip+len')} || ' / ' || {mm('1200-tip')} as end_time_elapsed_game,
  {mm('len')} as duration, '' as event, {mm('tip')} as start_time_in_period, {mm('1200-tip')} as start_time_remaining,
  {mm('tip+len')} as end_time_in_period, {mm('1200-tip')} as end_time_remaining, len as duration_seconds,
  cast(case when shift_id%50=0 then 4 else per end as int) as period_number, tip as start_time_in_period_seconds,
  1200-tip as start_time_remaining_seconds, tip+len as end_time_in_period_seconds, 1200-tip as end_time_remaining_seconds
 from q join place using (gameId, team_type, part, playerId)""",
    "report_summary": f"""with {SHIFT_PLACES},
 s as (select gameId, team_type, part, playerId, count(*) as n, cast(sum(len) as bigint) as t from q group by 1,2,3,4)
 select gameId, team_type, part, start + s.n as seq, (playerId+10) || ' PLAYER, NR' || playerId as player_name, cast(playerId+10 as int) as jersey_number,
  'TEAM ' || team_type as team_name, case when playerId%5=0 then 'OT' else '1' end as period, cast(s.n as int) as shifts_count,
  {mm('t//s.n')} as average_duration, {mm('t')} as total_ice_time, {mm('t-1')} as even_strength_total, '0:01' as power_play_total,
  '' as short_handed_total, cast(t//s.n as int) as average_duration_seconds, cast(t as int) as total_ice_time_seconds,
  cast(t-1 as int) as even_strength_total_seconds, 1 as power_play_total_seconds, cast(null as int) as short_handed_total_seconds,
  case when playerId%5=0 then 4 else 1 end as period_number
 from s join place using (gameId, team_type, part, playerId)""",
    "report_counts": f"""with {SHIFT_ROWS}
 select gameId, team_type, part, count(distinct playerId) as players_count, true as parsing_successful, count(*) as total_shifts,
  count(distinct playerId) as total_summary_records from q group by 1,2,3""",
    "report_rosters": f"""with {CUSTOMERS}
 select c.report, case when spot<16 or spot between 32 and 35 then 'Away' else 'Home' end as team_type,
  case when spot<32 then 'roster' else 'scratch' end as status,
  cast(row_number() over (partition by c.report, case when spot<32 then spot//16 else spot//4 end order by spot)-1 as int) as seq, cast(c_custkey%98+1 as varchar) as number, letter as position,
  c_name as name, case when letter='G' then 1 else 0 end as is_goalie
 from c join docs using (report) where spot>=32 or (spot<16 and na>=15) or (spot between 16 and 31 and nh>=15)""",
    "report_coaches": f"""with {CUSTOMERS}
 select report, coalesce(max(c_name) filter (spot=0),'') as away_coach, coalesce(max(c_name) filter (spot=16),'') as home_coach from c group by 1""",
    "report_officials": f"""with {CUSTOMERS}
 select report, case when spot<3 then 'referees' when spot=3 then 'linesmen' else 'standby' end as section, [1,2,4,6][spot] as seq,
  lower(c_name) as name
 from c where spot between 1 and 4""",
    "report_game_info": f"""with {CUSTOMERS}, d as (select report, report%3=0 as l, report%2=0 as ev, date '2024-01-01' + cast(report%365 as int) as day from docs)
 select report, case when l then 'unknown day' else strftime(day,'%Y-%m-%dT00:00:00') end as date,
  case when l then 'unknown day' else strftime(day,'%A, %B %-d, %Y') end as date_raw,
  case when not l then cast(10000+report*7 as varchar) end as attendance, case when not l then 'Rink ' || report end as venue,
  case when ev then '7:08 PM EDT' else '19:08 EST' end as start_time_raw,
  case when l then '19:08:00' else strftime(day,'%Y-%m-%dT19:08:00') end as start_time, case when ev then 'EDT' else 'EST' end as start_timezone,
  case when ev then '9:38 PM EDT' else '99:99' end as end_time_raw,
  case when not ev then '99:99' when l then '21:38:00' else strftime(day,'%Y-%m-%dT21:38:00') end as end_time,
  case when ev then 'EDT' end as end_timezone,
  case when l then 'date=unknown day,start_end=' || case when ev then 'Start 7:08 PM EDT; End 9:38 PM EDT' else 'Start 19:08 EST; End 99:99' end
    || ',game_type=T' || report else '' end as labels from d""",
    "feed_teams": f"""select s_suppkey as id, s_name as fullName, {nulls({'teamCommonName': 'varchar', 'teamPlaceName': 'varchar'})},
  s_suppkey%90+1917 as firstSeason_id, {nulls({'lastSeason_id': 'bigint'})}, 'records' as source from supplier""",
    "feed_schedule": f"""select o_orderkey as id, cast(20242025 as bigint) as season, {nulls({'gameType': 'int'})},
  strftime(o_orderdate,'%Y-%m-%d') as gameDate, 'Rink ' || (o_orderkey%32) as venue_default,
  {nulls({'neutralSite': 'boolean', 'startTimeUTC': 'varchar', 'easternUTCOffset': 'varchar', 'venueUTCOffset': 'varchar', 'gameState': 'varchar'})},
  o_orderkey%31 as awayTeam_id, 'AWY' as awayTeam_abbrev, cast(o_orderkey%7 as int) as awayTeam_score,
  o_orderkey%32 as homeTeam_id, 'HOM' as homeTeam_abbrev, cast(null as int) as homeTeam_score, 'NHL Schedule API' as source from orders""",
    "feed_standings": f"""select {nulls({'conferenceName': 'varchar', 'divisionName': 'varchar', 'date': 'varchar'})},
  cast(s_suppkey%82 as int) as gamesPlayed, {nulls({'goalFor': 'int', 'goalAgainst': 'int'})}, cast(s_suppkey%41 as int) as wins,
  {nulls({'losses': 'int', 'otLosses': 'int'})}, cast(s_suppkey%41*2 as int) as points, {nulls({'pointPctg': 'double'})},
  s_name as teamName_default, {nulls({'teamAbbrev_default': 'varchar'})}, 'NHL Standings API' as source from supplier""",
    "feed_roster": f"""select c_custkey as id, {nulls({'headshot': 'varchar', 'firstName_default': 'varchar'})}, c_name as lastName_default,
  cast(c_custkey%98+1 as int) as sweaterNumber, {nulls({'positionCode': 'varchar', 'shootsCatches': 'varchar', 'heightInInches': 'int', 'weightInPounds': 'int', 'birthDate': 'varchar', 'birthCountry': 'varchar'})},
  'NHL Roster API' as source from customer""",
    "feed_team_stats": f"""select c_custkey as playerId, {nulls({'headshot': 'varchar'})}, 'A' as firstName_default, c_name as lastName_default,
  {nulls({'positionCode': 'varchar'})}, cast(c_custkey%82 as int) as gamesPlayed, cast(c_custkey%50 as int) as goals,
  {nulls({'assists': 'int', 'points': 'int', 'plusMinus': 'int', 'penaltyMinutes': 'int', 'shots': 'int', 'shootingPctg': 'double'})},
  round(c_acctbal,6) as avgTimeOnIcePerGame, 'NHL Team Stats API' as source from customer""",
    "feed_team_stats_goalies": f"""select c_custkey as playerId, {nulls({'headshot': 'varchar'})}, 'A' as firstName_default, c_name as lastName_default,
  cast(c_custkey%82 as int) as gamesPlayed, {nulls({'wins': 'int', 'losses': 'int', 'goalsAgainstAverage': 'double', 'savePercentage': 'double'})},
  cast(c_custkey%9 as int) as shutouts, {nulls({'timeOnIce': 'int'})}, 'NHL Team Stats API' as source from customer""",
    "feed_draft_picks": f"""select cast(p_partkey%7+1 as int) as round, {nulls({'pickInRound': 'int'})}, cast(p_partkey as int) as overallPick,
  {nulls({'teamId': 'bigint', 'teamAbbrev': 'varchar', 'firstName_default': 'varchar'})}, p_name as lastName_default,
  {nulls({'positionCode': 'varchar', 'countryCode': 'varchar'})}, p_size as height, {nulls({'weight': 'int', 'amateurLeague': 'varchar'})},
  '2024' as year, 'NHL Draft API' as source from part""",
    **{
        name: f"""select p_partkey as id, cast(p_partkey%60+1963 as int) as draftYear,
  {nulls({'roundNumber': 'int', 'pickInRound': 'int', 'overallPickNumber': 'int', 'playerId': 'bigint'})}, p_name as playerName,
  {nulls({'position': 'varchar', 'draftedByTeamId': 'bigint', 'amateurClubName': 'varchar', 'countryCode': 'varchar'})},
  p_partkey%32 as team_id, p_brand as team_fullName, {nulls({'team_triCode': 'varchar'})},{year} '{source}' as source from part"""
        for name, year, source in (
            ("feed_draft_records", " '2025' as year,", "NHL Draft Records API"),
            ("feed_team_draft_history", "", "NHL Team Draft History API"),
        )
    },
    "feed_plays": f"""with {PBP}, p as (select * from pbp where Event not in ('ON','OFF'))
 select event_id//100 as gameId, row_number() over (partition by event_id//100 order by event_id)-1 as seq, event_id as eventId, period,
  {mm2('elapsedTime%1200')} as timeInPeriod, case Event when 'GOAL' then 'goal' when 'SHOT' then 'shot-on-goal' else 'stoppage' end as event_api,
  case when Event='GOAL' then 'https://replays.example.org/' || (event_id//100) || '/ev' || event_id || '.json' end as pptReplayUrl,
  case when Event='GOAL' then user_id end as scoringPlayerId, case when Event='SHOT' then user_id end as shootingPlayerId, xCoord, homeScore,
  cast(k%2+1 as bigint) as eventOwnerTeamId from p""",
    "feed_roster_spots": f"""with {PBP}, g as (select distinct event_id//100 as g from pbp where Event not in ('ON','OFF'))
 select g as gameId, cast(t as bigint) as teamId, g*10+n as playerId, n as sweaterNumber, 'C' as positionCode, 'F' || g || ' L' || n as fullName,
  cast(null as varchar) as headshot, case when t=1 then 1 else 0 end as isHome from g, (values (1,4),(2,9)) v(t,n)""",
    "feed_game_meta": f"""with {PBP}, g as (select distinct event_id//100 as g from pbp where Event not in ('ON','OFF'))
 select g as gameId, 'Rink ' || g as venue, 'Town' as venueLocation, cast(date '2024-01-01' + cast(g%300 as int) as varchar) as gameDate, 2 as gameType,
  cast(null as varchar) as startTimeUTC, '-05:00' as easternUTCOffset, cast(null as varchar) as venueUTCOffset, cast(1 as bigint) as homeId, 'AAA' as homeTeam,
  cast(2 as bigint) as awayId, 'BBB' as awayTeam from g""",
    "goal_replay": f"""with {PBP}
 select event_id//100 as gameId, event_id as eventId, cast(i as int) as frame_index, event_id*10+i as timeStamp,
  '{{"timeStamp":' || (event_id*10+i) || ',"onIce":{{"id":' || user_id || '}}}}' as frame
 from pbp, (values (0),(1),(2)) v(i) where Event='GOAL'""",
    "enriched_plays": f"""with {PBP}
 select event_id//100 as gameId, event_id as eventId, 'Rink ' || (event_id//100) as venue, 'Town' as venueLocation,
  cast(date '2024-01-01' + cast(event_id//100%300 as int) as varchar) as gameDate, 2 as gameType, cast(null as varchar) as startTimeUTC,
  '-05:00' as easternUTCOffset, cast(null as varchar) as venueUTCOffset, 'NHL Play-by-Play API' as source,
  case when Event='GOAL' then cast(4 + 3*length('{{"timeStamp":,"onIce":{{"id":}}}}') + length(cast(event_id*10 as varchar)) +
   length(cast(event_id*10+1 as varchar)) + length(cast(event_id*10+2 as varchar)) + 3*length(cast(user_id as varchar)) as int) end as replay_length
 from pbp where Event not in ('ON','OFF')""",
}
