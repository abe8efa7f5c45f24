"""Results as files: CSV for each table, and one page with map, counts and tables of all sections."""

from __future__ import annotations

import html
import json
from dataclasses import asdict
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.plans.sections import Section, Tables

def color(n: int, of: int) -> str:
    """One of `of` hues at even distances."""
    return f"hsl({360 * n // max(1, of)} 60% 45%)"


def stamp() -> str:
    return datetime.now().strftime("%Y%m%dT%H%M%S")


def csv_ready(df: DataFrame) -> DataFrame:
    """Without geometry; booleans as True and False, lists joined by semicolons, null as nothing."""
    df = df.drop("geometry")
    for name, kind in df.dtypes:
        if kind == "boolean":
            df = df.withColumn(name, F.when(F.col(name), "True").when(~F.col(name), "False"))
        elif kind.startswith("array"):
            df = df.withColumn(name, F.array_join(F.transform(name, lambda x: x.cast("string")), ";"))
    return df


def write_csvs(tables: Tables, out_dir: str, when: str) -> list[str]:
    """One CSV folder for each table, `name_stamp.csv`, written by Spark wherever `out_dir` is."""
    out = []
    for name, df in tables.items():
        path = f"{out_dir}/{name}_{when}.csv"
        csv_ready(df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
        out.append(path)
    return out


def page(sections: list[Section], title: str, subtitle: str = "") -> str:
    payload = {"title": title, "subtitle": subtitle, "sections": [asdict(s) | {"color": color(i, len(sections))} for i, s in enumerate(sections)]}
    data = json.dumps(payload, default=str).replace("</", "<\\/")
    return _PAGE.replace("@TITLE@", html.escape(title)).replace("@DATA@", data)


def write_report(sections: list[Section], path: str, title: str, subtitle: str = "") -> str:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(page(sections, title, subtitle), encoding="utf-8")
    return path


# The map is drawn as SVG from the tiles' polygons, so that the page needs no network.
_PAGE = r"""<!doctype html>
<html lang="en"><head><meta charset="utf-8"><title>@TITLE@</title>
<style>
:root{color-scheme:light dark;--line:color-mix(in srgb,currentColor 18%,transparent)}
body{font:15px/1.45 system-ui,sans-serif;margin:2rem auto;max-width:78rem;padding:0 1rem}
.cards{display:flex;flex-wrap:wrap;gap:.75rem}.card{border:1px solid var(--line);border-radius:.5rem;padding:.6rem 1rem}
.card b{font-size:1.4rem;display:block}.ok b{color:#2a9d6f}.bad b{color:#c94444}
svg{width:100%;height:24rem;border:1px solid var(--line);border-radius:.5rem;margin:1rem 0}
table{border-collapse:collapse;width:100%;font-size:.85rem}th,td{border-bottom:1px solid var(--line);padding:.25rem .5rem;text-align:left;vertical-align:top}
th{cursor:pointer}.scroll{overflow:auto;max-height:32rem}.summary tr{cursor:pointer}input{padding:.3rem .5rem;width:22rem;max-width:100%}label{margin-right:1rem}
</style></head><body>
<h1></h1><p id="sub"></p><div class="cards"></div><div id="layers"></div><svg></svg><div id="tip"></div><main></main>
<script id="data" type="application/json">@DATA@</script>
<script>
const report=JSON.parse(document.getElementById("data").textContent),SHOWN=1000,NS="http://www.w3.org/2000/svg";
const make=(tag,text,parent)=>{const e=document.createElement(tag);if(text!==undefined)e.textContent=text;if(parent)parent.append(e);return e};
document.querySelector("h1").textContent=report.title;document.getElementById("sub").textContent=report.subtitle;
for(const s of report.sections){const c=make("div",undefined,document.querySelector(".cards"));c.className="card "+(s.n_failures?"bad":"ok");make("span",s.title,c);make("b",String(s.n_failures),c);make("span",`flagged of ${s.n_checked} checked`,c)}
const blank=v=>(v??"")==="";
const words=new Intl.Collator(undefined,{sensitivity:"base"});
const rings=w=>[...w.matchAll(/\(([^()]*)\)/g)].map(m=>m[1].split(",").map(p=>p.trim().split(/\s+/).map(Number)));
const svg=document.querySelector("svg");let box=[180,90,-180,-90];
for(const [i,s] of report.sections.entries()){const g=document.createElementNS(NS,"g");svg.append(g);
 const l=make("label",undefined,document.getElementById("layers")),c=make("input",undefined,l);c.type="checkbox";c.checked=true;c.style.width="auto";c.onchange=()=>g.style.display=c.checked?"":"none";l.append(" "+s.title);l.style.color=s.color;
 for(const f of s.features){if(!f.geometry)continue;for(const r of rings(f.geometry)){for(const [x,y] of r)box=[Math.min(box[0],x),Math.min(box[1],y),Math.max(box[2],x),Math.max(box[3],y)];
  const p=document.createElementNS(NS,"polygon");p.setAttribute("points",r.map(([x,y])=>x+","+-y).join(" "));p.setAttribute("fill",s.color);p.setAttribute("fill-opacity",".45");p.setAttribute("stroke",s.color);p.setAttribute("vector-effect","non-scaling-stroke");
  p.onclick=()=>{const t=document.getElementById("tip");t.replaceChildren();make("h3",`${s.title}: ${f.mgrs_tile_id} (${f.n_failures})`,t);for(const row of f.rows)make("p",Object.entries(row).filter(([k,v])=>!blank(v)&&k!=="mgrs_tile_id"&&k!=="_nth"&&k!=="mgrs_tile_wkt").map(([k,v])=>`${k}: ${v}`).join(" · "),t);if(f.n_failures>f.rows.length)make("p",`… ${f.n_failures-f.rows.length} more`,t)};
  g.append(p)}}}
if(box[0]<=box[2])svg.setAttribute("viewBox",`${box[0]-1} ${-box[3]-1} ${box[2]-box[0]+2} ${box[3]-box[1]+2}`);else svg.remove();
// A grid holds each record once with its cells as text and a text to search; it sorts that list in place and shows what matches.
class Grid{
 constructor(section,parent){
  this.names=section.columns;this.key=section.key;
  this.lines=section.records.map(r=>{const cells=this.names.map(n=>blank(r[n])?"":String(r[n]));return{cells,text:cells.join("\u0001").toLowerCase()}});
  const bar=make("p",undefined,parent);this.box=make("input",undefined,bar);this.box.type="search";this.box.placeholder="Find in any column";this.box.addEventListener("input",()=>this.show());
  this.link=make("a","Download as CSV",bar);this.link.download=`${this.key}.csv`;this.link.href="#";this.link.addEventListener("click",()=>{this.link.href="data:text/csv;charset=utf-8,"+encodeURIComponent(this.csv())});
  this.note=make("small",undefined,bar);
  const pane=make("div",undefined,parent);pane.className="scroll";const table=make("table",undefined,pane),titles=table.createTHead().insertRow();this.body=table.createTBody();
  this.names.forEach((n,i)=>{const cell=make("th",n,titles);cell.addEventListener("click",()=>{const up=cell.getAttribute("aria-sort")!=="ascending";for(const other of titles.cells)other.removeAttribute("aria-sort");cell.setAttribute("aria-sort",up?"ascending":"descending");this.sort(i,up);this.show()})});
  this.show()}
 matching(){const wanted=this.box.value.toLowerCase();return wanted?this.lines.filter(l=>l.text.includes(wanted)):this.lines}
 sort(i,up){
  const full=this.lines.filter(l=>l.cells[i]!==""),empty=this.lines.filter(l=>l.cells[i]==="");
  const numbers=full.every(l=>Number.isFinite(Number(l.cells[i])));
  full.sort(numbers?(x,y)=>Number(x.cells[i])-Number(y.cells[i]):(x,y)=>words.compare(x.cells[i],y.cells[i]));
  this.lines=(up?full:full.reverse()).concat(empty)}
 csv(){return[this.names,...this.matching().map(l=>l.cells)].map(cells=>cells.map(t=>`"${t.split('"').join('""')}"`).join(",")).join("\r\n")}
 show(){
  const found=this.matching(),part=document.createDocumentFragment();
  for(const{cells}of found.slice(0,SHOWN)){const tr=make("tr",undefined,part);for(const t of cells){const td=make("td",undefined,tr);if(/^https?:/.test(t))make("a","open",td).href=t;else td.textContent=t}}
  this.body.replaceChildren(part);this.note.textContent=found.length>SHOWN?` the first ${SHOWN} of ${found.length} matches`:` ${found.length} matches`}
 search(text){this.box.value=text;this.show()}
}
for(const s of report.sections){
 const part=make("section",undefined,document.querySelector("main"));make("h2",s.title,part);make("p",s.description,part);
 if(s.truncated)make("p",`This page holds ${s.records.length} of ${s.n_failures} rows; the CSV files hold all.`,part);
 const grid=new Grid(s,part);
 if(!s.summary)continue;
 make("h3",s.summary.title,part);const counts=make("table",undefined,part);counts.className="summary";const titles=counts.insertRow();for(const n of s.summary.columns)make("th",n,titles);
 for(const r of s.summary.records){const values=s.summary.columns.map(n=>String(r[n]??"")),tr=counts.insertRow();for(const v of values)make("td",v,tr);tr.addEventListener("click",()=>grid.search(values[0]))}}
</script></body></html>
"""
