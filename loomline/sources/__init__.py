"""Readers and writers; network services are interfaces with local implementations."""
