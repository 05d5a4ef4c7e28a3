"""Stages: operators put together, and the run that connects them."""
