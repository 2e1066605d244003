"""Learners (Spark ML and user-level), score tables and the leaderboard."""
