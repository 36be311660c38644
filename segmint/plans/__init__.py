"""Specs (what is graded) and the composed pipeline / registered queries."""
