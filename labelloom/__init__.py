"""Labelled-text preparation, labelling and evaluation as Spark DataFrame functions."""
