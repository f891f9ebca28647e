"""Inputs: contacts, reference lists, mail-routing and registration snapshots."""
