"""Stages composed from operators."""
