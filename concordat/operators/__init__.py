"""Operators over whole tables: DataFrame in, lazy DataFrame out."""
