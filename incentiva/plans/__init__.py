"""Composed jobs, session settings and plan inspection."""
