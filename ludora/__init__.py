"""ludora: a Spark-native engine for game-review analytics and recommendation.

Everything runs as Spark DataFrame / SQL / MLlib jobs: integrate a game
catalogue with user reviews, clean and profile the tables, split each
user's history in time, build candidate sets, score them with several
recommenders for all users at once and evaluate the rankings.
"""

__version__ = "0.1.0"
