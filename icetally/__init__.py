"""icetally: hockey play-by-play, shift and time-on-ice analytics as Spark DataFrames.

Every operator takes DataFrames holding any number of games and returns a lazy DataFrame.
"""
