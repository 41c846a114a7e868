"""Column roles: which columns of a table are settings, sensors, target, label and id."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names the parts of a measurement table.

    ``sensors`` decide verdicts; ``extra`` sensors only take part in duplicate keys and features and
    may be absent from a table.
    """

    id: str = "test_id"
    settings: tuple[str, ...] = ("voltage", "current_a", "ambient", "duration")
    sensors: tuple[str, ...] = ("s1", "s2", "s3")
    extra: tuple[str, ...] = ("s4",)
    target: str = "ref"
    label: str = "label"
    valid: str = "Valid"
    invalid: str = "Invalid"

    @property
    def all_sensors(self) -> list[str]:
        return [*self.sensors, *self.extra]

    @property
    def measurements(self) -> list[str]:
        """The columns that together identify one physical test."""
        return [*self.settings, *self.sensors, *self.extra]

    @property
    def numeric(self) -> list[str]:
        return [*self.measurements, self.target]
