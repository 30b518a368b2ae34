"""All stages of the feed over one staged table.

Stages are lazy up to the few tables that several later stages read; ``keep`` writes those to shared
storage and reads them back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame

from feedgate.contract import FeedContract
from feedgate.functions import filters
from feedgate.functions.columns import LINE_ID
from feedgate.operators import disposition, gate, header, identity, measures, reconcile, staging, versions

Keep = Callable[..., DataFrame]


class FeedPlan:
    def __init__(
        self,
        staged: DataFrame,
        graph: DataFrame,
        expected: DataFrame,
        contract: FeedContract,
        keep: Keep,
        ingested_at: Column,
        issues: DataFrame | None = None,
    ):
        self.staged = staged
        self.graph = graph
        self.expected = expected
        self.contract = contract
        self.ingested_at = ingested_at
        self.issues = issues
        self._keep = keep

    @cached_property
    def normalized(self) -> DataFrame:
        return staging.with_row_hash(staging.normalize(self.staged, self.contract), self.contract)

    @cached_property
    def tokens(self) -> DataFrame:
        return self._keep("tokens", identity.resolve_tokens(self.graph))

    @cached_property
    def identified(self) -> DataFrame:
        """Typed lines with hash, person id and token flags: the one wide table all stages read.

        Partitioned by delivery, so that later stages never open the files of a blocked one. It is not
        rebalanced for that: a task reads lines of one delivery unless the token join shuffled them.
        """
        typed = staging.normalize(self.staged, self.contract)
        # Hashed after the join, so that a large token table does not make the hash travel with the lines.
        hashed = staging.with_row_hash(identity.identify(typed, self.tokens), self.contract)
        lines = versions.with_line_id(hashed)
        return self._keep("identified", lines, partition="_delivery_month")

    @cached_property
    def recurring(self) -> DataFrame:
        """The filter of the keys that several lines have: lines of other keys are neither compared nor ranked."""
        return self._keep("recurring", filters.recurring_filter(self.identified, self.contract.line_key))

    def _several(self, lines: DataFrame) -> DataFrame:
        return filters.candidates(lines, self.recurring, self.contract.line_key)

    def _filter_of(self, name: str, rows: DataFrame, key: list[str]) -> DataFrame | None:
        """A written filter of a written table that is too long to be broadcast."""
        if rows.count() < filters.FILTER_FROM:
            return None
        return self._keep(name, filters.bit_filter(rows, key))

    @cached_property
    def repeated(self) -> DataFrame:
        return self._keep("repeated", measures.repeated_in_delivery(self._several(self.identified), self.contract))

    @cached_property
    def conflicts(self) -> DataFrame:
        found = measures.same_delivery_conflicts(self.identified, self.contract, self.repeated)
        return self._keep("conflicts", found)

    @cached_property
    def results(self) -> DataFrame:
        measured = measures.contract_measures(self.identified, self.contract)
        return self._keep("validation_results", measures.volume_band(measured, self.contract))

    @cached_property
    def decisions(self) -> DataFrame:
        reasons = gate.gate_reasons(self.expected, self.results, self.conflicts, self.issues)
        return self._keep("promotion_decisions", gate.promotion_decisions(reasons, self.contract))

    @cached_property
    def accepted(self) -> DataFrame:
        return identity.accepted(self.identified, self.decisions)

    @cached_property
    def key_dupes(self) -> DataFrame:
        return self._keep("key_dupes", measures.global_key_dupes(self._several(self.identified), self.contract))

    @cached_property
    def patient_tokens(self) -> DataFrame:
        return self._keep("patient_tokens", identity.token_patient_ambiguous(self.identified))

    @cached_property
    def marks(self) -> DataFrame | None:
        """Lines that other lines speak against, once for all stages; none where the gate leaves nothing to mark."""
        issues = {} if self.contract.conflicts_block else {"conflicts": self.conflicts}
        if self.contract.extended_warnings:
            issues |= {"key_dupes": self.key_dupes, "patient_tokens": self.patient_tokens}
        if not issues:
            return None
        found = disposition.line_marks(self.accepted, self.contract, **issues, recurring=self.recurring)
        return self._keep("marks", found)

    @cached_property
    def marked_ids(self) -> DataFrame | None:
        return None if self.marks is None else self._filter_of("marked_ids", self.marks, [LINE_ID])

    @cached_property
    def held(self) -> DataFrame:
        if self.marks is None:
            return disposition.hold(self.accepted, self.contract)
        lines = versions.packed(self.accepted)
        return versions.unpacked(disposition.hold(lines, self.contract, self.marks, self.marked_ids))

    @cached_property
    def disposed(self) -> DataFrame:
        return disposition.grade(self.held, self.contract)

    @cached_property
    def eligible(self) -> DataFrame:
        return disposition.eligible(self.held)

    @cached_property
    def quarantine_lines(self) -> DataFrame:
        return disposition.quarantine(self.held, self.contract, self.ingested_at)

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._keep("silver_claim_line_quarantine", self.quarantine_lines)

    @cached_property
    def slim(self) -> DataFrame:
        return versions.slim_versions(self.eligible, self.contract)

    @cached_property
    def _packed(self) -> DataFrame:
        return versions.earliest_copies(versions.packed(self.slim), self.contract)

    @cached_property
    def earliest(self) -> DataFrame:
        return versions.unpacked(self._packed)

    @cached_property
    def latest(self) -> DataFrame:
        """Without the hash, which nothing reads once the version is chosen."""
        return self._keep("latest", versions.latest_lines(self.slim, self.contract, self.recurring))

    @cached_property
    def replaced(self) -> DataFrame:
        return self._keep("replaced", versions.replaced_claims(self.latest))

    @cached_property
    def exceptions(self) -> DataFrame:
        claims = self._filter_of("replaced_claims", self.replaced, ["claim_id"])
        recurring = (self.recurring, list(self.contract.line_key))
        found = versions.exceptions(self.slim, self.latest, self.replaced, recurring, claims)
        return self._keep("exceptions", found)

    @cached_property
    def _excepted_ids(self) -> DataFrame | None:
        """The filter of all line ids that silver lines are joined with: exceptions, and marks if there are any."""
        ids = self.exceptions.select(LINE_ID)
        if self.marks is not None:
            ids = ids.unionByName(self.marks.select(LINE_ID))
        return self._filter_of("excepted_ids", ids, [LINE_ID])

    @cached_property
    def silver_lines(self) -> DataFrame:
        """Where exceptions are many, only lines that may be one are shuffled to them; the others stay where they are read."""

        if self._excepted_ids is None:
            lines = versions.packed(self.eligible)
            return versions.unpacked(versions.silver_line(lines, self.exceptions, self.contract, self.ingested_at))

        def silver(lines: DataFrame, marks: DataFrame | None, excepted: DataFrame | None) -> DataFrame:
            kept = disposition.eligible(disposition.hold(lines, self.contract, marks))
            return versions.silver_line(kept, excepted, self.contract, self.ingested_at)

        lines, ids = versions.packed(self.accepted), self._excepted_ids
        clear = silver(filters.others(lines, ids, [LINE_ID]), None, None)
        rest = silver(filters.candidates(lines, ids, [LINE_ID]), self.marks, self.exceptions)
        return versions.unpacked(clear.unionByName(rest))

    @cached_property
    def silver(self) -> DataFrame:
        return self._keep("silver_claim_line", self.silver_lines)

    @cached_property
    def headers(self) -> DataFrame:
        return self._keep("silver_claim_header", header.claim_header(self.silver))

    @cached_property
    def reconciliation(self) -> DataFrame:
        counted = reconcile.reconciliation(self.decisions, self.held, self.exceptions, self.silver)
        return self._keep("reconciliation", counted)

    @cached_property
    def incomplete_keys(self) -> DataFrame:
        return reconcile.incomplete_keys(self.slim, self.latest, self.contract)

    @cached_property
    def totals(self) -> DataFrame:
        return reconcile.run_totals(self.silver, self.quarantine)
