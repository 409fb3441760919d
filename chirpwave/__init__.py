"""chirpwave: social-post stream analytics on Spark DataFrames.

Sentiment of posts, US-state normalisation of free-text places, windowed
per-state sentiment, trending hashtags, sentiment joined with weather and
a per-state snapshot -- each one DataFrame plan that runs on batch tables
and on Structured Streaming.
"""

__version__ = "0.1.0"
