"""SQL twins of the queries, for an independent engine over the same tables."""

from __future__ import annotations

import re

# Named sub-queries; a statement gets those it mentions, in this order.
VIEWS: dict[str, str] = {}
STATEMENTS: dict[str, str] = {}

VIEWS["donors"] = """
    SELECT r_name AS sample_id, 'C' || c_custkey || '-1' AS barcode, c_custkey, c_acctbal, c_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
VIEWS["lines"] = """
    SELECT d.sample_id, d.barcode, d.c_custkey, l_partkey, l_quantity, l_returnflag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN donors d ON o_custkey = d.c_custkey"""
VIEWS["counts"] = """
    SELECT sample_id, barcode, l_partkey AS feature_id, CAST(sum(l_quantity) AS BIGINT) AS n
    FROM lines GROUP BY ALL"""
VIEWS["survivors"] = """
    SELECT c.* FROM counts c SEMI JOIN (
        SELECT sample_id, barcode FROM counts WHERE n > 0 GROUP BY ALL HAVING count(*) >= 20
    ) USING (sample_id, barcode)"""
VIEWS["kept_axis"] = """
    SELECT sample_id, feature_id, count(*) AS n_cells FROM survivors WHERE n > 0
    GROUP BY ALL HAVING count(*) >= 3"""
VIEWS["kept"] = "SELECT s.* FROM survivors s SEMI JOIN kept_axis USING (sample_id, feature_id)"
VIEWS["plain_cells"] = """
    SELECT sample_id, barcode, CAST(sum(n) AS BIGINT) AS n_count,
        count(*) FILTER (WHERE n > 0) AS n_feature,
        1e2 * sum(CASE WHEN regexp_matches(p_name, '^red ') THEN n ELSE 0 END) / nullif(sum(n), 0) AS pct_mt,
        1e2 * sum(CASE WHEN regexp_matches(p_name, '^[hs]') THEN n ELSE 0 END) / nullif(sum(n), 0) AS pct_rb
    FROM kept JOIN part ON feature_id = p_partkey GROUP BY sample_id, barcode"""
VIEWS["droplet_sizes"] = """
    SELECT sample_id, barcode, sum(n) AS n, count(*) FILTER (WHERE n > 0) AS f FROM counts GROUP BY ALL"""
VIEWS["barcodes"] = """
    SELECT sample_id, 'raw' AS call_set, barcode, c_custkey AS ord FROM donors
    UNION ALL
    SELECT sample_id, 'filtered', barcode, c_custkey FROM donors JOIN droplet_sizes USING (sample_id, barcode)
    WHERE n >= 500
    UNION ALL
    SELECT sample_id, 'denoised', barcode, c_custkey FROM donors JOIN droplet_sizes USING (sample_id, barcode)
    WHERE f >= 30"""
VIEWS["nuclear"] = """
    SELECT l.sample_id, l.barcode AS cell_barcode, l.c_custkey,
        count(*) FILTER (WHERE l_returnflag = 'N')
            / nullif(count(*) FILTER (WHERE l_returnflag IN ('N', 'A')), 0) AS nuclear_fraction
    FROM lines l SEMI JOIN (SELECT * FROM barcodes WHERE call_set = 'denoised') b
        ON l.sample_id = b.sample_id AND l.barcode = b.barcode
    GROUP BY ALL"""
VIEWS["nuclear_metrics"] = """
    SELECT sample_id, 'C' || c_custkey AS cell_barcode, nuclear_fraction, c_custkey AS ord FROM nuclear
    UNION ALL
    SELECT sample_id, 'C' || c_custkey || '-2', CAST(0 AS DOUBLE), c_custkey + 1000000000
    FROM nuclear JOIN (SELECT c_custkey FROM donors WHERE c_mktsegment = 'BUILDING') USING (c_custkey)"""
VIEWS["doublet_metrics"] = """
    SELECT sample_id, barcode AS cell_barcode, (c_acctbal + 1000) / 11000 AS doublet_score,
        CASE WHEN (c_acctbal + 1000) / 11000 > 0.9e0 THEN 'doublet' ELSE 'singlet' END AS doublet_class,
        c_custkey AS ord
    FROM donors"""
VIEWS["nuclear_first"] = """
    SELECT sample_id, split_part(cell_barcode, '-', 1) AS bc, nuclear_fraction FROM nuclear_metrics
    QUALIFY row_number() OVER (PARTITION BY sample_id, split_part(cell_barcode, '-', 1) ORDER BY ord) = 1"""
VIEWS["doublet_first"] = """
    SELECT sample_id, split_part(cell_barcode, '-', 1) AS bc, doublet_score, doublet_class FROM doublet_metrics
    QUALIFY row_number() OVER (PARTITION BY sample_id, split_part(cell_barcode, '-', 1) ORDER BY ord) = 1"""
VIEWS["attached"] = """
    SELECT c.*, n.nuclear_fraction, d.doublet_score, d.doublet_class
    FROM plain_cells c
    LEFT JOIN nuclear_first n ON n.sample_id = c.sample_id AND n.bc = split_part(c.barcode, '-', 1)
    LEFT JOIN doublet_first d ON d.sample_id = c.sample_id AND d.bc = split_part(c.barcode, '-', 1)"""
VIEWS["cells"] = """
    SELECT *, coalesce(n_feature >= 20 AND n_count >= 500 AND pct_mt <= 20 AND nuclear_fraction >= 0.4e0
        AND lower(doublet_class) <> 'doublet', false) AS keep
    FROM attached"""
VIEWS["overview"] = """
    SELECT c.sample_id, count(*) AS total_cells, median(n_count) AS median_umi,
        median(n_feature) AS median_features, avg(n_count) AS mean_umi, avg(n_feature) AS mean_features,
        avg(pct_mt) AS mean_mt_pct, avg(pct_rb) AS mean_rb_pct,
        avg(nuclear_fraction) AS mean_nuclear_fraction,
        1e2 * avg(CASE WHEN doublet_class = 'doublet' THEN 1 WHEN doublet_class IS NOT NULL THEN 0 END)
            AS doublet_rate_pct,
        count(*) FILTER (WHERE keep) AS cells_post, 1e2 * count(*) FILTER (WHERE keep) / count(*) AS pct_retained,
        any_value(f.total_features) AS total_features
    FROM cells c LEFT JOIN (SELECT sample_id, count(*) AS total_features FROM kept_axis GROUP BY ALL) f
        USING (sample_id)
    GROUP BY c.sample_id"""
VIEWS["metadata"] = """
    SELECT r_name AS sampleid, CAST(r_regionkey AS BIGINT) AS batch FROM region WHERE r_name <> 'AFRICA'
    UNION ALL SELECT r_name, CAST(r_regionkey AS BIGINT) FROM region WHERE r_name = 'ASIA'"""
VIEWS["set_sizes"] = """
    SELECT sample_id, count(*) FILTER (WHERE call_set = 'raw') AS n_raw,
        count(*) FILTER (WHERE call_set = 'filtered') AS n_filtered,
        nullif(count(*) FILTER (WHERE call_set = 'denoised'), 0) AS n_denoised
    FROM barcodes GROUP BY ALL"""
VIEWS["droplet_umi"] = """
    SELECT b.sample_id, b.barcode, b.ord, coalesce(CAST(s.n AS BIGINT), 0) AS umi
    FROM barcodes b LEFT JOIN droplet_sizes s USING (sample_id, barcode) WHERE call_set = 'raw'"""
VIEWS["long_metrics"] = """
    SELECT sample_id, 'n_feature' AS metric, CAST(n_feature AS DOUBLE) AS value FROM cells
    UNION ALL SELECT sample_id, 'n_count', CAST(n_count AS DOUBLE) FROM cells
    UNION ALL SELECT sample_id, 'pct_mt', pct_mt FROM cells
    UNION ALL SELECT sample_id, 'nuclear_fraction', nuclear_fraction FROM cells
    UNION ALL SELECT sample_id, 'doublet_score', doublet_score FROM cells"""
VIEWS["fragments"] = """
    SELECT 'S' || (user_id % 4) AS sample_id, 'U' || user_id || '-1' AS barcode, event_type AS chrom,
        date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 1000000 AS "start",
        date_diff('microsecond', TIMESTAMP '2024-01-01', ts) // 1000000 + CAST(floor(value * 5) AS BIGINT) + 1
            AS "end",
        user_id
    FROM events"""
VIEWS["chroms"] = "SELECT DISTINCT event_type AS chrom FROM events"
VIEWS["peaks"] = """
    SELECT chrom, "start", "start" + 2000 AS "end" FROM chroms, (SELECT range AS "start" FROM range(0, 2600000, 10000))"""
VIEWS["blacklist"] = """
    SELECT chrom, "start", "start" + 2000 AS "end" FROM chroms, (SELECT range AS "start" FROM range(0, 2600000, 500000))"""
VIEWS["tss"] = "SELECT chrom, pos FROM chroms, (SELECT range AS pos FROM range(5000, 2600000, 20000))"
VIEWS["peak_triplets"] = """
    SELECT f.sample_id, f.barcode, p.chrom || ':' || p."start" || '-' || p."end" AS feature_id, count(*) AS n
    FROM fragments f JOIN peaks p ON f.chrom = p.chrom AND f."start" < p."end" AND p."start" < f."end"
    GROUP BY ALL"""
VIEWS["peak_totals"] = """
    SELECT sample_id, barcode, CAST(sum(n) AS BIGINT) AS n_count_atac, count(*) AS n_feature_atac
    FROM peak_triplets GROUP BY ALL"""
VIEWS["fragment_totals"] = "SELECT sample_id, barcode, count(*) AS fragments FROM fragments GROUP BY ALL"
VIEWS["nucleosome"] = """
    SELECT sample_id, barcode, count(*) FILTER (WHERE "end" - "start" BETWEEN 147 AND 294) AS n_mono,
        count(*) FILTER (WHERE "end" - "start" < 147) AS n_free,
        count(*) FILTER (WHERE "end" - "start" BETWEEN 147 AND 294)
            / nullif(count(*) FILTER (WHERE "end" - "start" < 147), 0) AS nucleosome_signal
    FROM fragments GROUP BY ALL"""
VIEWS["blacklist_share"] = """
    SELECT sample_id, barcode, sum(CASE WHEN b.feature_id IS NOT NULL THEN n ELSE 0 END) / nullif(sum(n), 0)
            AS blacklist_fraction
    FROM peak_triplets LEFT JOIN (
        SELECT DISTINCT p.chrom || ':' || p."start" || '-' || p."end" AS feature_id
        FROM peaks p JOIN blacklist b ON p.chrom = b.chrom AND p."start" < b."end" AND b."start" < p."end"
    ) b USING (feature_id)
    GROUP BY sample_id, barcode"""
VIEWS["insertions"] = """
    SELECT sample_id, barcode, chrom, "start" AS pos FROM fragments
    UNION ALL SELECT sample_id, barcode, chrom, "end" FROM fragments"""
VIEWS["tss_hits"] = """
    SELECT sample_id, barcode, count(*) FILTER (WHERE i.pos - t.pos < -900 OR i.pos - t.pos > 900) AS flank,
        count(*) FILTER (WHERE i.pos - t.pos BETWEEN -501 AND 499) AS centre
    FROM insertions i JOIN tss t ON i.chrom = t.chrom AND i.pos BETWEEN t.pos - 1000 AND t.pos + 1000
    GROUP BY ALL"""
VIEWS["tss_cells"] = """
    SELECT f.sample_id, f.barcode, coalesce(flank, 0) AS flank, coalesce(centre, 0) AS centre
    FROM fragment_totals f LEFT JOIN tss_hits USING (sample_id, barcode)"""
VIEWS["tss_scores"] = """
    SELECT sample_id, barcode, flank, centre, (centre / 1001e0) / nullif(
        CASE WHEN flank > 0 THEN flank / 200e0 ELSE avg(flank / 200e0) OVER (PARTITION BY sample_id) END, 0)
            AS tss_enrichment
    FROM tss_cells"""
VIEWS["chromatin"] = """
    SELECT p.*, s.nucleosome_signal, t.tss_enrichment, f.fragments, p.n_count_atac / nullif(f.fragments, 0) AS frip,
        b.blacklist_fraction
    FROM peak_totals p LEFT JOIN nucleosome s USING (sample_id, barcode)
    LEFT JOIN tss_scores t USING (sample_id, barcode) LEFT JOIN fragment_totals f USING (sample_id, barcode)
    LEFT JOIN blacklist_share b USING (sample_id, barcode)"""
VIEWS["chromatin_flags"] = """
    SELECT *, n_count_atac > 10 AND n_count_atac < 20 AS pass_counts, n_feature_atac > 12 AS pass_features,
        tss_enrichment > 1 AS pass_tss, nucleosome_signal < 0.6e0 AS pass_nucleosome,
        blacklist_fraction < 0.05e0 AS pass_blacklist,
        n_count_atac > 10 AND n_count_atac < 20 AND n_feature_atac > 12 AND tss_enrichment > 1
            AND nucleosome_signal < 0.6e0 AND blacklist_fraction < 0.05e0 AS pass_all
    FROM chromatin"""
VIEWS["long_chromatin"] = """
    SELECT sample_id, unnest(['n_count_atac', 'n_feature_atac', 'nucleosome_signal', 'tss_enrichment',
            'fragments', 'frip', 'blacklist_fraction']) AS metric,
        unnest([CAST(n_count_atac AS DOUBLE), CAST(n_feature_atac AS DOUBLE), nucleosome_signal, tss_enrichment,
            CAST(fragments AS DOUBLE), frip, blacklist_fraction]) AS value
    FROM chromatin"""
VIEWS["paired_fragments"] = """
    SELECT d.sample_id, 'C' || user_id || '-2' AS barcode, chrom, "start", "end", user_id
    FROM (SELECT * EXCLUDE (sample_id, barcode) FROM fragments) f JOIN donors d ON d.c_custkey = f.user_id"""
VIEWS["paired_peaks"] = """
    SELECT f.sample_id, f.barcode, p.chrom || ':' || p."start" || '-' || p."end" AS feature_id, count(*) AS n
    FROM paired_fragments f JOIN peaks p ON f.chrom = p.chrom AND f."start" < p."end" AND p."start" < f."end"
    GROUP BY ALL"""
VIEWS["both_modalities"] = """
    SELECT sample_id, barcode, 'Gene Expression' AS modality, CAST(feature_id AS VARCHAR) AS feature_id, n FROM counts
    UNION ALL SELECT sample_id, barcode, 'Peaks', feature_id, n FROM paired_peaks"""
VIEWS["pairs"] = """
    SELECT c.sample_id, c.barcode, p.barcode AS right_barcode
    FROM plain_cells c JOIN (SELECT DISTINCT sample_id, barcode FROM paired_fragments) p
        ON c.sample_id = p.sample_id AND split_part(c.barcode, '-', 1) = split_part(p.barcode, '-', 1)"""
VIEWS["normalised"] = """
    SELECT k.sample_id, k.barcode, k.feature_id, k.n, ln(1 + k.n * 1e4 / c.n_count) AS x
    FROM kept k JOIN plain_cells c USING (sample_id, barcode)"""
VIEWS["cell_number"] = "SELECT sample_id, count(*) AS n_all FROM plain_cells GROUP BY ALL"
VIEWS["background"] = """
    SELECT sample_id, feature_id, n_all, mean, sd, coalesce(-mean / nullif(sd, 0), 0) AS z0 FROM (
        SELECT sample_id, feature_id, any_value(n_all) AS n_all, sum(x) / any_value(n_all) AS mean,
            sqrt(greatest((sum(x * x) - sum(x) * sum(x) / any_value(n_all)) / nullif(any_value(n_all) - 1, 0), 0)) AS sd
        FROM normalised JOIN cell_number USING (sample_id) GROUP BY sample_id, feature_id)"""
VIEWS["vectors"] = """
    SELECT 'G' || (vec_id % 2) AS sample_id, vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label
    FROM embeddings"""
VIEWS["near"] = """
    SELECT sample_id, src, dst, sqrt(d2) AS dist, rank FROM (
        SELECT sample_id, src, dst, d2,
            row_number() OVER (PARTITION BY sample_id, src ORDER BY d2, dst) AS rank
        FROM (
            SELECT a.sample_id, a.id AS src, b.id AS dst,
                round(power(list_distance(a.vec, b.vec), 2), 9) AS d2
            FROM vectors a JOIN vectors b ON a.sample_id = b.sample_id AND a.id <> b.id))
    WHERE rank <= 20"""
VIEWS["members"] = "SELECT sample_id, src, dst FROM near UNION ALL SELECT sample_id, id, id FROM vectors"

STATEMENTS["sample_overview"] = """
    SELECT sample_id, total_cells, ROUND(median_umi, 6) AS median_umi, ROUND(median_features, 6) AS median_features,
        ROUND(mean_umi, 6) AS mean_umi, ROUND(mean_features, 6) AS mean_features,
        ROUND(mean_mt_pct, 6) AS mean_mt_pct, ROUND(mean_rb_pct, 6) AS mean_rb_pct,
        ROUND(mean_nuclear_fraction, 6) AS mean_nuclear_fraction, ROUND(doublet_rate_pct, 6) AS doublet_rate_pct,
        cells_post, ROUND(pct_retained, 6) AS pct_retained, total_features
    FROM overview"""
STATEMENTS["cell_metrics"] = """
    SELECT sample_id, barcode, n_count, n_feature, ROUND(pct_mt, 6) AS pct_mt, ROUND(pct_rb, 6) AS pct_rb
    FROM plain_cells"""
STATEMENTS["gene_detection"] = "SELECT sample_id, feature_id, n_cells FROM kept_axis"
STATEMENTS["kept_counts"] = "SELECT sample_id, barcode, feature_id, n FROM kept"
STATEMENTS["feature_classes"] = """
    SELECT p_partkey AS feature_id, regexp_matches(p_name, '^red ') AS is_mt, regexp_matches(p_name, '^[hs]') AS is_rb
    FROM part WHERE regexp_matches(p_name, '^red ') OR regexp_matches(p_name, '^[hs]')"""
STATEMENTS["nuclear_fraction"] = """
    SELECT sample_id, cell_barcode, ROUND(nuclear_fraction, 6) AS nuclear_fraction FROM nuclear"""
VIEWS["nuclear_stats"] = """
    SELECT sample_id, count(*) AS total_cells, ROUND(avg(nuclear_fraction), 6) AS mean_nuclear_fraction,
        ROUND(stddev_samp(nuclear_fraction), 6) AS sd_nuclear_fraction,
        ROUND(min(nuclear_fraction), 6) AS min_nuclear_fraction,
        ROUND(max(nuclear_fraction), 6) AS max_nuclear_fraction,
        ROUND(median(nuclear_fraction), 6) AS median_nuclear_fraction
    FROM nuclear GROUP BY ALL"""
STATEMENTS["nuclear_summary"] = "SELECT * FROM nuclear_stats"
STATEMENTS["nuclear_summary_rows"] = """
    SELECT sample_id, unnest(['total_cells', 'mean_nuclear_fraction', 'sd_nuclear_fraction', 'min_nuclear_fraction',
            'max_nuclear_fraction', 'median_nuclear_fraction']) AS metric,
        unnest([CAST(total_cells AS DOUBLE), mean_nuclear_fraction, sd_nuclear_fraction, min_nuclear_fraction,
            max_nuclear_fraction, median_nuclear_fraction]) AS value
    FROM nuclear_stats"""
STATEMENTS["doublet_summary"] = """
    SELECT sample_id, count(*) AS total_cells, count(*) FILTER (WHERE doublet_class = 'singlet') AS singlets,
        count(*) FILTER (WHERE doublet_class = 'doublet') AS doublets,
        round_even(1e2 * count(*) FILTER (WHERE doublet_class = 'doublet') / count(*), 2) AS doublet_rate,
        ROUND(avg(doublet_score), 6) AS mean_score, ROUND(median(doublet_score), 6) AS median_score
    FROM doublet_metrics GROUP BY ALL"""
STATEMENTS["doublet_class_counts"] = """
    SELECT sample_id, doublet_class, count(*) AS n,
        round_even(1e2 * count(*) / sum(count(*)) OVER (PARTITION BY sample_id), 1) AS pct
    FROM cells WHERE doublet_class IS NOT NULL GROUP BY sample_id, doublet_class"""
STATEMENTS["doublet_class_line"] = """
    SELECT sample_id, string_agg(doublet_class || ': ' || n, ', ' ORDER BY doublet_class) AS classes
    FROM (SELECT sample_id, doublet_class, count(*) AS n FROM cells WHERE doublet_class IS NOT NULL GROUP BY ALL)
    GROUP BY sample_id"""
STATEMENTS["metric_attach_first_match"] = """
    SELECT sample_id, barcode, ROUND(nuclear_fraction, 6) AS nuclear_fraction FROM attached"""
STATEMENTS["match_coverage"] = """
    SELECT c.sample_id, count(*) AS n_cells, count(n.bc) AS n_matched
    FROM plain_cells c LEFT JOIN nuclear_first n
        ON n.sample_id = c.sample_id AND n.bc = split_part(c.barcode, '-', 1)
    GROUP BY c.sample_id"""
STATEMENTS["metadata_attach"] = """
    SELECT sample_id, barcode, batch FROM plain_cells LEFT JOIN (
        SELECT sampleid, any_value(batch) AS batch FROM metadata GROUP BY sampleid HAVING count(*) = 1)
        ON sampleid = sample_id"""
STATEMENTS["sample_inputs"] = """
    SELECT * FROM (SELECT sample_id, count(*) AS n_cells FROM plain_cells GROUP BY ALL)
    JOIN (SELECT sample_id, count(*) AS n_nuclear FROM nuclear_metrics GROUP BY ALL) USING (sample_id)
    JOIN (SELECT sample_id, count(*) AS n_doublet FROM doublet_metrics GROUP BY ALL) USING (sample_id)
    JOIN (SELECT sampleid AS sample_id, count(*) AS n_metadata FROM metadata GROUP BY ALL) USING (sample_id)"""
STATEMENTS["qc_filter_keep"] = """
    SELECT sample_id, barcode, n_count, n_feature, ROUND(pct_mt, 6) AS pct_mt,
        ROUND(nuclear_fraction, 6) AS nuclear_fraction, doublet_class
    FROM cells WHERE keep"""
VIEWS["kept_share"] = """
    SELECT sample_id, count(*) AS cells_pre, count(*) FILTER (WHERE keep) AS cells_post,
        count(*) - count(*) FILTER (WHERE keep) AS cells_lost,
        round_even(1e2 * count(*) FILTER (WHERE keep) / count(*), 2) AS pct_retained,
        round_even(1e2 * (count(*) - count(*) FILTER (WHERE keep)) / count(*), 2) AS pct_lost
    FROM cells GROUP BY ALL"""
STATEMENTS["retention"] = "SELECT * FROM kept_share"
STATEMENTS["qc_loss_breakdown"] = """
    SELECT *, round_even(1e2 * doublets_removed / cells_pre, 2) AS doublets_removed_pct,
        round_even(1e2 * nuclear_removed / cells_pre, 2) AS nuclear_removed_pct,
        round_even(1e2 * mito_removed / cells_pre, 2) AS mito_removed_pct
    FROM (
        SELECT c.sample_id, count(*) AS cells_pre,
            count(*) FILTER (WHERE doublet_class = 'doublet') AS doublets_removed,
            count(*) FILTER (WHERE nuclear_fraction < lo) AS nuclear_removed,
            count(*) FILTER (WHERE pct_mt > hi) AS mito_removed
        FROM cells c LEFT JOIN (
            SELECT sample_id, min(nuclear_fraction) AS lo, max(pct_mt) AS hi FROM cells WHERE keep GROUP BY ALL
        ) USING (sample_id)
        GROUP BY c.sample_id)"""
VIEWS["long_flagged"] = """
    SELECT sample_id, keep, unnest(['n_count', 'n_feature', 'pct_mt', 'nuclear_fraction', 'doublet_score']) AS metric,
        unnest([CAST(n_count AS DOUBLE), CAST(n_feature AS DOUBLE), pct_mt, nuclear_fraction, doublet_score]) AS value
    FROM cells"""
VIEWS["pre_post"] = """
    SELECT sample_id, cells_pre, cells_post, metric, avg(value) AS mean_pre, stddev_samp(value) AS sd_pre,
        avg(value) FILTER (WHERE keep) AS mean_post, stddev_samp(value) FILTER (WHERE keep) AS sd_post
    FROM long_flagged JOIN kept_share USING (sample_id) GROUP BY ALL"""
STATEMENTS["pre_post_summary"] = """
    SELECT sample_id, cells_pre, cells_post, metric, ROUND(mean_pre, 6) AS mean_pre, ROUND(sd_pre, 6) AS sd_pre,
        ROUND(mean_post, 6) AS mean_post, ROUND(sd_post, 6) AS sd_post
    FROM pre_post"""


def _plain(x: str, digits: str) -> str:
    return f"regexp_replace(CAST(round_even({x}, {digits}) AS VARCHAR), '\\.0$', '')"


def _thousands(x: str) -> str:
    return f"format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT))"


def _mean_sd(side: str) -> str:
    m, s = f"mean_{side}", f"sd_{side}"
    return f"""CASE WHEN metric IN ('n_count', 'n_feature') THEN {_thousands(m)} || ' ± ' || {_thousands(s)}
            WHEN metric = 'pct_mt' THEN {_plain(m, '2')} || ' ± ' || {_plain(s, '2')}
            ELSE {_plain(m, '3')} || ' ± ' || {_plain(s, '3')} END"""


STATEMENTS["pre_post_report"] = f"""
    SELECT sample_id, CAST(pos AS BIGINT) AS pos, metric, pre_qc, post_qc FROM (
        SELECT sample_id, 1 AS pos, 'Sample Name' AS metric, sample_id AS pre_qc, sample_id AS post_qc FROM kept_share
        UNION ALL SELECT sample_id, 2, 'Total Cells', {_thousands('cells_pre')}, {_thousands('cells_post')} FROM kept_share
        UNION ALL SELECT sample_id, 3, 'Cells Lost', '0', {_thousands('cells_lost')} FROM kept_share
        UNION ALL SELECT sample_id, 4, 'Cells Retained (%)', '100%', {_plain('pct_retained', '2')} || '%' FROM kept_share
        UNION ALL SELECT sample_id, 5, 'Cells Lost (%)', '0%', {_plain('pct_lost', '2')} || '%' FROM kept_share
        UNION ALL SELECT sample_id, 6, 'Total Features', {_thousands('count(*)')}, {_thousands('count(*)')}
            FROM kept_axis GROUP BY sample_id
        UNION ALL SELECT sample_id,
            7 + list_position(['n_count', 'n_feature', 'pct_mt', 'nuclear_fraction', 'doublet_score'], metric),
            metric || ' (mean ± sd)', {_mean_sd('pre')}, {_mean_sd('post')} FROM pre_post
        UNION ALL SELECT sample_id, 13, 'Doublet Classification',
            string_agg(doublet_class || ': ' || a, ', ' ORDER BY doublet_class),
            string_agg(doublet_class || ': ' || b, ', ' ORDER BY doublet_class) FILTER (WHERE b > 0)
            FROM (SELECT sample_id, doublet_class, count(*) AS a, count(*) FILTER (WHERE keep) AS b FROM cells
                WHERE doublet_class IS NOT NULL GROUP BY ALL) GROUP BY sample_id)"""
STATEMENTS["droplet_counts"] = """
    SELECT sample_id, metric, "count", ROUND(1e2 * "count" / nullif(n_raw, 0), 6) AS percentage_of_raw FROM (
        SELECT sample_id, n_raw, unnest(['total_raw_droplets', 'called_cells', 'denoised_called_cells']) AS metric,
            unnest([n_raw, n_filtered, n_denoised]) AS "count" FROM set_sizes)"""
VIEWS["comparison"] = """
    SELECT sample_id, 1 AS pos, 'called' AS method, n_filtered AS cells_called,
        CASE WHEN n_denoised IS NOT NULL THEN 1e2 END AS pct_of_base, 1e2 * n_filtered / nullif(n_raw, 0) AS pct_of_raw
    FROM set_sizes
    UNION ALL SELECT sample_id, 2, 'denoised', n_denoised, 1e2 * n_denoised / nullif(n_filtered, 0),
        1e2 * n_denoised / nullif(n_raw, 0) FROM set_sizes WHERE n_denoised IS NOT NULL
    UNION ALL SELECT sample_id, 3, 'difference', n_denoised - n_filtered,
        round_even(1e2 * (n_denoised - n_filtered) / nullif(n_filtered, 0), 2), NULL
    FROM set_sizes WHERE n_denoised IS NOT NULL"""
STATEMENTS["called_comparison"] = """
    SELECT sample_id, CAST(pos AS BIGINT) AS pos, method, cells_called, ROUND(pct_of_base, 6) AS pct_of_base,
        ROUND(pct_of_raw, 6) AS pct_of_raw
    FROM comparison"""
STATEMENTS["called_comparison_text"] = """
    SELECT sample_id, CAST(pos AS BIGINT) AS pos, method, format('{:,}', cells_called) AS cells_called,
        CASE WHEN pct_of_base IS NULL THEN NULL WHEN method = 'called' THEN '100%'
            WHEN method = 'difference' THEN printf('%+.2f%%', pct_of_base) ELSE printf('%.2f%%', pct_of_base) END
            AS pct_of_base,
        CASE WHEN method = 'difference' THEN '' ELSE printf('%.2f%%', pct_of_raw) END AS pct_of_raw
    FROM comparison"""
STATEMENTS["difference_status"] = """
    SELECT sample_id, diff_pct,
        CASE WHEN diff_pct <= 5 THEN 'OK' WHEN diff_pct <= 20 THEN 'Warning' ELSE 'Attention' END AS status
    FROM (SELECT sample_id, abs(round_even(1e2 * (n_denoised - n_filtered) / n_filtered, 2)) AS diff_pct
        FROM set_sizes WHERE n_denoised IS NOT NULL AND n_filtered > 0)"""
STATEMENTS["called_overlap"] = """
    SELECT sample_id, count(*) FILTER (WHERE a AND b) AS in_both, count(*) FILTER (WHERE a AND NOT b) AS only_filtered,
        count(*) FILTER (WHERE b AND NOT a) AS only_denoised
    FROM (SELECT sample_id, barcode, bool_or(call_set = 'filtered') AS a, bool_or(call_set = 'denoised') AS b
        FROM barcodes WHERE call_set <> 'raw' GROUP BY ALL) GROUP BY sample_id"""
STATEMENTS["umi_per_droplet"] = "SELECT sample_id, barcode, ord, umi FROM droplet_umi"
for _name, _set in (("knee_ranks", "filtered"), ("knee_ranks_denoised", "denoised")):
    STATEMENTS[_name] = f"""
    SELECT sample_id, barcode, ord, umi,
        CASE WHEN barcode IN (SELECT barcode FROM barcodes WHERE call_set = '{_set}') THEN 'Called'
            ELSE 'Background' END AS called,
        row_number() OVER (PARTITION BY sample_id ORDER BY umi DESC, ord) AS rank
    FROM droplet_umi"""
VIEWS["shares"] = """
    SELECT sample_id, feature_id, CAST(sum(n) AS BIGINT) AS total,
        1e2 * sum(n) / sum(sum(n)) OVER (PARTITION BY sample_id) AS pct
    FROM kept GROUP BY sample_id, feature_id"""
STATEMENTS["feature_share"] = "SELECT sample_id, feature_id, total, ROUND(pct, 6) AS pct FROM shares"
STATEMENTS["top_features"] = """
    SELECT sample_id, feature_id, total, ROUND(pct, 6) AS pct,
        row_number() OVER (PARTITION BY sample_id ORDER BY total DESC, feature_id) AS rank
    FROM shares QUALIFY rank <= 10"""
STATEMENTS["top_features_overall"] = """
    SELECT feature_id, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY ALL ORDER BY total DESC, feature_id LIMIT 10"""
STATEMENTS["recommended_thresholds"] = """
    SELECT sample_id, round_even(quantile_cont(n_feature, 0.01), 0) AS min_features,
        round_even(quantile_cont(n_feature, 0.99), 0) AS max_features,
        round_even(quantile_cont(pct_mt, 0.95), 1) AS max_mt_pct
    FROM plain_cells GROUP BY ALL"""
for _name, _view in (("metric_quantiles", "long_metrics"), ("atac_metric_summary", "long_chromatin")):
    STATEMENTS[_name] = f"""
    SELECT sample_id, metric, ROUND(min(value), 6) AS min, ROUND(quantile_cont(value, 0.25), 6) AS q1,
        ROUND(median(value), 6) AS median, ROUND(avg(value), 6) AS mean, ROUND(quantile_cont(value, 0.75), 6) AS q3,
        ROUND(max(value), 6) AS max
    FROM {_view} GROUP BY ALL"""
STATEMENTS["assessment"] = """
    SELECT sample_id, unnest(['cell_count', 'median_umi', 'median_features', 'mean_mt_pct', 'data_quality']) AS aspect,
        unnest([CAST(total_cells AS DOUBLE), ROUND(median_umi, 6), ROUND(median_features, 6), ROUND(mean_mt_pct, 6),
            CASE WHEN median_umi > 1000 AND mean_mt_pct < 20 THEN 1e0 ELSE 0e0 END]) AS value,
        unnest([CASE WHEN total_cells > 500 THEN 'Adequate' ELSE 'Low' END,
            CASE WHEN median_umi > 1000 THEN 'Good' ELSE 'Low' END,
            CASE WHEN median_features > 500 THEN 'Good' ELSE 'Low' END,
            CASE WHEN mean_mt_pct < 20 THEN 'Good' ELSE 'High' END,
            CASE WHEN median_umi > 1000 AND mean_mt_pct < 20 THEN 'High' ELSE 'Moderate' END]) AS status
    FROM overview"""
STATEMENTS["axis_ranges"] = """
    SELECT sample_id, metric, ROUND(lo, 6) AS lo, ROUND(hi, 6) AS hi FROM (
        SELECT sample_id, metric,
            CASE WHEN metric IN ('n_feature', 'n_count')
                THEN greatest(0e0, a - 0.05e0 * (b - a)) ELSE 0e0 END AS lo,
            CASE WHEN metric IN ('n_feature', 'n_count') THEN b + 0.05e0 * (b - a)
                WHEN metric = 'pct_mt' THEN 100e0 ELSE 1e0 END AS hi
        FROM (SELECT sample_id, metric, min(value) AS a, max(value) AS b FROM long_metrics GROUP BY ALL))"""


def _bin(value: str, lo: str, hi: str, bins: int) -> str:
    return (
        f"CAST(least(coalesce(floor(({value} - {lo}) / nullif({hi} - {lo}, 0) * {bins}) + 1, 1), {bins}) AS BIGINT)"
    )


STATEMENTS["metric_histogram"] = f"""
    SELECT sample_id, metric, {_bin('value', 'lo', 'hi', 50)} AS bin, count(*) AS n, ROUND(lo, 6) AS lo, ROUND(hi, 6) AS hi
    FROM (
        SELECT sample_id, metric, log10(value) AS value, min(log10(value)) OVER w AS lo, max(log10(value)) OVER w AS hi
        FROM long_metrics WHERE metric IN ('n_count', 'n_feature') AND value > 0
        WINDOW w AS (PARTITION BY sample_id, metric))
    GROUP BY sample_id, metric, bin, lo, hi"""
STATEMENTS["score_histogram"] = f"""
    SELECT sample_id, 'doublet_score' AS metric, doublet_class, {_bin('value', 'lo', 'hi', 50)} AS bin, count(*) AS n,
        ROUND(lo, 6) AS lo, ROUND(hi, 6) AS hi
    FROM (
        SELECT sample_id, doublet_class, doublet_score AS value, min(doublet_score) OVER w AS lo,
            max(doublet_score) OVER w AS hi
        FROM cells WHERE doublet_score IS NOT NULL WINDOW w AS (PARTITION BY sample_id))
    GROUP BY sample_id, doublet_class, bin, lo, hi"""
STATEMENTS["metric_distribution"] = """
    SELECT sample_id, metric, unnest([0.05e0, 0.25e0, 0.5e0, 0.75e0, 0.95e0]) AS prob,
        unnest([ROUND(quantile_cont(value, 0.05), 6), ROUND(quantile_cont(value, 0.25), 6),
            ROUND(quantile_cont(value, 0.5), 6), ROUND(quantile_cont(value, 0.75), 6),
            ROUND(quantile_cont(value, 0.95), 6)]) AS value
    FROM long_metrics GROUP BY sample_id, metric"""
STATEMENTS["metric_trend"] = " UNION ALL ".join(
    f"""
    SELECT sample_id, '{x}' AS x, '{y}' AS y, ROUND(regr_slope({y}, {x}), 6) AS slope,
        ROUND(regr_intercept({y}, {x}), 6) AS intercept, ROUND(regr_r2({y}, {x}), 6) AS r2
    FROM cells GROUP BY ALL"""
    for x, y in (
        ("n_count", "n_feature"),
        ("n_count", "pct_mt"),
        ("n_count", "nuclear_fraction"),
        ("n_feature", "nuclear_fraction"),
    )
)
_QC = ("n_feature", "n_count", "pct_mt", "nuclear_fraction", "doublet_score")
STATEMENTS["metric_correlation"] = " UNION ALL ".join(
    f"SELECT sample_id, '{a}' AS x, '{b}' AS y, ROUND(corr({a}, {b}), 6) AS r FROM cells GROUP BY ALL"
    for i, a in enumerate(_QC)
    for b in _QC[i + 1 :]
)
STATEMENTS["modality_inventory"] = """
    SELECT sample_id, modality, count(DISTINCT feature_id) AS n_features, count(DISTINCT barcode) AS n_barcodes
    FROM both_modalities GROUP BY ALL"""
STATEMENTS["modality_select"] = """
    SELECT sample_id, barcode, modality, feature_id, n FROM both_modalities WHERE modality = 'Gene Expression'"""
STATEMENTS["common_barcodes"] = "SELECT sample_id, split_part(barcode, '-', 1) AS bc_clean FROM pairs"
STATEMENTS["cross_modality_join"] = "SELECT sample_id, barcode, right_barcode FROM pairs"
STATEMENTS["paired_peak_totals"] = """
    SELECT c.sample_id, c.barcode, c.n_count, c.keep, t.n_count_atac, t.n_feature_atac
    FROM cells c JOIN pairs p USING (sample_id, barcode) LEFT JOIN (
        SELECT sample_id, barcode, CAST(sum(n) AS BIGINT) AS n_count_atac, count(*) AS n_feature_atac
        FROM paired_peaks GROUP BY ALL) t
        ON t.sample_id = p.sample_id AND t.barcode = p.right_barcode"""
STATEMENTS["fragment_counts"] = "SELECT sample_id, barcode, fragments FROM fragment_totals"
STATEMENTS["fragments_on_cells"] = """
    SELECT d.sample_id, d.barcode, f.fragments FROM donors d LEFT JOIN (
        SELECT user_id, count(*) AS fragments FROM paired_fragments GROUP BY ALL) f ON f.user_id = d.c_custkey"""
STATEMENTS["nucleosome_signal"] = """
    SELECT sample_id, barcode, n_mono, n_free, ROUND(nucleosome_signal, 6) AS nucleosome_signal FROM nucleosome"""
STATEMENTS["fragment_lengths"] = """
    SELECT sample_id, "end" - "start" AS length, count(*) AS n FROM fragments
    WHERE chrom = 'view' AND "start" < 2000000 AND "end" > 0 GROUP BY ALL"""
STATEMENTS["peak_counts"] = """
    SELECT sample_id, 'Peaks' AS modality, barcode, feature_id, n FROM peak_triplets"""
STATEMENTS["peak_cell_totals"] = "SELECT sample_id, barcode, n_count_atac, n_feature_atac FROM peak_totals"
STATEMENTS["frip"] = """
    SELECT sample_id, barcode, n_count_atac, n_feature_atac, fragments, ROUND(frip, 6) AS frip FROM chromatin"""
STATEMENTS["blacklist_fraction"] = """
    SELECT sample_id, barcode, ROUND(blacklist_fraction, 6) AS blacklist_fraction FROM blacklist_share"""
STATEMENTS["tss_enrichment"] = """
    SELECT sample_id, barcode, flank, centre, ROUND(tss_enrichment, 6) AS tss_enrichment FROM tss_scores"""
STATEMENTS["chromatin_cells"] = """
    SELECT sample_id, barcode, n_count_atac, n_feature_atac, ROUND(nucleosome_signal, 6) AS nucleosome_signal,
        ROUND(tss_enrichment, 6) AS tss_enrichment, fragments, ROUND(frip, 6) AS frip,
        ROUND(blacklist_fraction, 6) AS blacklist_fraction, pass_counts, pass_features, pass_tss, pass_nucleosome,
        pass_blacklist, pass_all
    FROM chromatin_flags"""
STATEMENTS["atac_pass"] = " UNION ALL ".join(
    f"""
    SELECT sample_id, count(*) AS n_total, '{f}' AS filter, count(*) FILTER (WHERE {f}) AS cells_passing,
        round_even(1e2 * count(*) FILTER (WHERE {f}) / count(*), 1) AS pct
    FROM chromatin_flags GROUP BY sample_id"""
    for f in ("pass_counts", "pass_features", "pass_tss", "pass_nucleosome", "pass_blacklist", "pass_all")
)
STATEMENTS["density_grid"] = f"""
    SELECT sample_id, {_bin('gx', 'x_lo', 'x_hi', 20)} AS bin_x, {_bin('gy', 'y_lo', 'y_hi', 20)} AS bin_y, count(*) AS n
    FROM (
        SELECT sample_id, gx, gy, min(gx) OVER w AS x_lo, max(gx) OVER w AS x_hi, min(gy) OVER w AS y_lo,
            max(gy) OVER w AS y_hi
        FROM (SELECT sample_id, log10(n_count_atac) AS gx, tss_enrichment AS gy FROM chromatin
            WHERE n_count_atac > 0 AND tss_enrichment IS NOT NULL)
        WINDOW w AS (PARTITION BY sample_id))
    GROUP BY ALL"""
STATEMENTS["density_guides"] = """
    SELECT sample_id, metric, unnest([0.05e0, 0.1e0, 0.9e0, 0.95e0]) AS prob,
        unnest([ROUND(quantile_cont(value, 0.05), 6), ROUND(quantile_cont(value, 0.1), 6),
            ROUND(quantile_cont(value, 0.9), 6), ROUND(quantile_cont(value, 0.95), 6)]) AS value
    FROM long_chromatin WHERE metric IN ('n_count_atac', 'tss_enrichment') GROUP BY sample_id, metric"""
STATEMENTS["log_normalised"] = "SELECT sample_id, barcode, feature_id, n, ROUND(x, 6) AS x FROM normalised"
STATEMENTS["scale_background"] = """
    SELECT sample_id, feature_id, n_all, ROUND(mean, 6) AS mean, ROUND(sd, 6) AS sd, ROUND(z0, 6) AS z0 FROM background"""
STATEMENTS["scaled"] = """
    SELECT sample_id, barcode, feature_id, ROUND(least(coalesce((x - mean) / nullif(sd, 0), 0), 10), 6) AS z,
        ROUND(z0, 6) AS z0
    FROM normalised JOIN background USING (sample_id, feature_id)"""
STATEMENTS["marker_expression"] = """
    SELECT c.sample_id, c.barcode, 'large ring' AS feature_name, f.sample_id IS NOT NULL AS found,
        CASE WHEN f.sample_id IS NOT NULL THEN ROUND(coalesce(m.x, 0), 6) END AS x
    FROM plain_cells c LEFT JOIN (
        SELECT sample_id, min(feature_id) AS feature_id FROM kept_axis JOIN part ON feature_id = p_partkey
        WHERE p_name = 'large ring' GROUP BY ALL) f ON f.sample_id = c.sample_id
    LEFT JOIN normalised m
        ON m.sample_id = c.sample_id AND m.barcode = c.barcode AND m.feature_id = f.feature_id"""
STATEMENTS["feature_moments"] = """
    SELECT sample_id, feature_id, any_value(n_all) AS n_all, count(*) AS n_cells,
        ROUND(CAST(sum(n) AS DOUBLE) / any_value(n_all), 6) AS mean,
        ROUND((CAST(sum(n * n) AS DOUBLE) - CAST(sum(n) AS DOUBLE) * sum(n) / any_value(n_all))
            / (any_value(n_all) - 1), 6) AS var
    FROM kept JOIN cell_number USING (sample_id) GROUP BY sample_id, feature_id"""
STATEMENTS["knn"] = "SELECT sample_id, src, dst, ROUND(dist, 6) AS dist, rank FROM near"
STATEMENTS["shared_neighbours"] = """
    SELECT * FROM (
        SELECT a.sample_id, a.src AS src1, b.src AS src2, count(*) AS shared,
            ROUND(count(*) / (42e0 - count(*)), 6) AS weight
        FROM members a JOIN members b ON a.sample_id = b.sample_id AND a.dst = b.dst AND a.src < b.src
        GROUP BY ALL)
    WHERE shared / (42e0 - shared) >= 1 / 15e0"""

VIEWS["called_counts"] = """
    SELECT c.* FROM counts c SEMI JOIN (SELECT * FROM barcodes WHERE call_set = 'denoised') b
        ON c.sample_id = b.sample_id AND c.barcode = b.barcode"""
VIEWS["called_survivors"] = """
    SELECT c.* FROM called_counts c SEMI JOIN (
        SELECT sample_id, barcode FROM called_counts WHERE n > 0 GROUP BY ALL HAVING count(*) >= 20
    ) USING (sample_id, barcode)"""
VIEWS["called_kept"] = """
    SELECT s.* FROM called_survivors s SEMI JOIN (
        SELECT sample_id, feature_id FROM called_survivors WHERE n > 0 GROUP BY ALL HAVING count(*) >= 3
    ) USING (sample_id, feature_id)"""
STATEMENTS["denoised_cells"] = """
    SELECT sample_id, barcode, n_count, n_feature, ROUND(pct_mt, 6) AS pct_mt,
        n_feature >= 20 AND n_count >= 500 AND pct_mt <= 20 AS keep
    FROM (
        SELECT sample_id, barcode, CAST(sum(n) AS BIGINT) AS n_count, count(*) FILTER (WHERE n > 0) AS n_feature,
            1e2 * sum(CASE WHEN regexp_matches(p_name, '^red ') THEN n ELSE 0 END) / nullif(sum(n), 0) AS pct_mt
        FROM called_kept JOIN part ON feature_id = p_partkey GROUP BY sample_id, barcode)"""
STATEMENTS["stored_qc_tables"] = "SELECT sample_id, cells_pre, cells_post FROM kept_share"
STATEMENTS["stored_metric_csv"] = STATEMENTS["doublet_summary"]
STATEMENTS["republished_doublets"] = STATEMENTS["doublet_summary"]
STATEMENTS["mixed_metric_csv"] = STATEMENTS["doublet_summary"]
STATEMENTS["stored_modalities"] = """
    SELECT sample_id, 'Peaks' AS modality, count(*) AS entries, CAST(sum(n) AS BIGINT) AS n
    FROM paired_peaks GROUP BY sample_id"""
VIEWS["sample_peaks"] = """
    SELECT 'S' || k AS sample_id, chrom, "start" + 1500 * k AS "start", "start" + 1500 * k + 2000 AS "end"
    FROM chroms, (SELECT range AS "start" FROM range(0, 2600000, 10000)), (SELECT range AS k FROM range(4))
    UNION ALL
    SELECT 'S' || k, chrom, 100000 + k, 30100000 FROM chroms, (SELECT range AS k FROM range(4))"""
VIEWS["sample_triplets"] = """
    SELECT f.sample_id, f.barcode, p.chrom || ':' || p."start" || '-' || p."end" AS feature_id, count(*) AS n,
        any_value(EXISTS (SELECT 1 FROM blacklist b WHERE b.chrom = p.chrom AND b."start" < p."end"
            AND p."start" < b."end")) AS bad
    FROM fragments f JOIN sample_peaks p ON f.sample_id = p.sample_id AND f.chrom = p.chrom
        AND f."start" < p."end" AND p."start" < f."end"
    GROUP BY ALL"""
STATEMENTS["peak_counts_by_sample"] = """
    SELECT sample_id, 'Peaks' AS modality, barcode, feature_id, n FROM sample_triplets"""
STATEMENTS["blacklist_fraction_by_sample"] = """
    SELECT sample_id, barcode, ROUND(sum(CASE WHEN bad THEN n ELSE 0 END) / nullif(sum(n), 0), 6) AS blacklist_fraction
    FROM sample_triplets GROUP BY ALL"""
VIEWS["tss_stranded"] = """
    SELECT chrom, pos, CASE WHEN pos // 700 % 3 = 0 THEN -1 ELSE 1 END AS way
    FROM chroms, (SELECT range AS pos FROM range(5000, 2600000, 700))"""
VIEWS["stranded_hits"] = """
    SELECT sample_id, barcode, count(*) FILTER (WHERE way * (i.pos - t.pos) < -900 OR way * (i.pos - t.pos) > 900) AS flank,
        count(*) FILTER (WHERE way * (i.pos - t.pos) BETWEEN -501 AND 499) AS centre
    FROM insertions i JOIN tss_stranded t ON i.chrom = t.chrom AND i.pos BETWEEN t.pos - 1000 AND t.pos + 1000
    GROUP BY ALL"""
VIEWS["stranded_cells"] = """
    SELECT f.sample_id, f.barcode, coalesce(flank, 0) AS flank, coalesce(centre, 0) AS centre
    FROM fragment_totals f LEFT JOIN stranded_hits USING (sample_id, barcode)"""
STATEMENTS["tss_enrichment_stranded"] = """
    SELECT sample_id, barcode, flank, centre, ROUND((centre / 1001e0) / nullif(
        CASE WHEN flank > 0 THEN flank / 200e0 ELSE avg(flank / 200e0) OVER (PARTITION BY sample_id) END, 0), 6)
            AS tss_enrichment
    FROM stranded_cells"""
STATEMENTS["pre_post_clusters"] = """
    SELECT sample_id, cells_pre, cells_post, cells_pre AS clustered_pre, 0::BIGINT AS gaining_pre,
        cells_post AS clustered_post, 0::BIGINT AS gaining_post
    FROM kept_share"""
# The chromatin views once more, over the paired fragments.
_PAIRED = ("peak_triplets", "peak_totals", "fragment_totals", "nucleosome", "blacklist_share", "insertions", "tss_hits",
           "tss_cells", "tss_scores", "chromatin", "chromatin_flags")
for _name in _PAIRED:
    VIEWS["paired_" + _name] = re.sub(rf"\b({'|'.join((*_PAIRED, 'fragments'))})\b", r"paired_\1", VIEWS[_name])
VIEWS["post_chromatin"] = """
    SELECT * FROM paired_chromatin_flags f SEMI JOIN (SELECT * FROM cells WHERE keep) c
        ON f.sample_id = c.sample_id AND split_part(f.barcode, '-', 1) = split_part(c.barcode, '-', 1)"""
STATEMENTS["atac_pass_post_qc"] = STATEMENTS["atac_pass"].replace("chromatin_flags", "post_chromatin")
STATEMENTS["cluster_local_optimum"] = "SELECT sample_id, count(*) AS nodes, 0::BIGINT AS gaining FROM vectors GROUP BY ALL"
STATEMENTS["cluster_counts"] = "SELECT sample_id, count(DISTINCT label) AS n_clusters FROM vectors GROUP BY ALL"


def _needs(sql: str) -> set[str]:
    words = set(re.findall(r"\b[a-z_]+\b", sql))
    return words & VIEWS.keys()


def compose(sql: str) -> str:
    """The statement with the named sub-queries it needs in front."""
    wanted, todo = set(), _needs(sql)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo |= _needs(VIEWS[name]) - {name}
    if not wanted:
        return sql
    ordered, left = [], set(wanted)
    while left:
        ready = sorted(n for n in left if not (_needs(VIEWS[n]) - {n}) & left)
        ordered += ready
        left -= set(ready)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + sql


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in STATEMENTS.items()}
