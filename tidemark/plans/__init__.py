"""Whole pipelines built from the operators, and the views the registered queries run on."""
