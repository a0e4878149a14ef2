"""Readers, writers and the target model."""
