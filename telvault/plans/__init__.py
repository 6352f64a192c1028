"""Composed jobs: silver build, posture, gold composition, product runs."""
