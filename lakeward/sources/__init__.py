"""Readers. All of them return text columns unless stated otherwise."""
